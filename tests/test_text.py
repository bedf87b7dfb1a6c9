import itertools

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from warehaus.functions.text import accept_invalid_bytes, blank_as_null, clean_text, from_bytes, truncate_bytes


def per_value(v):
    """The per-value definition the native expression reproduces."""
    if v is None:
        return ""
    return v.encode("windows-1252", errors="ignore").decode("utf-8", errors="ignore")


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    out = dict((r.i, r.o) for r in df.select("i", expr(F.col("s")).alias("o")).collect())
    return [out[i] for i in range(len(values))]


CASES = [("abc", "abc"), ("cafÃ© x", "café x"), ("café x", "caf x"), ("中文a", "a"),
         ("€5", "5"), ("â‚¬9", "€9"), (None, ""), ("aï¿½b", "a�b"), ("ï中¿½", "�")]


def test_clean_text_cases(spark):
    got = run(spark, [c for c, _ in CASES], clean_text)
    assert got == [e for _, e in CASES]
    assert [per_value(c) for c, _ in CASES] == [e for _, e in CASES]


cp_text = st.text(alphabet=st.characters(max_codepoint=0x2FF) | st.sampled_from("€‚ƒ„…’“”•–—™ï¿½中😀"),
                  max_size=16)


@settings(max_examples=60, deadline=None)
@given(st.lists(cp_text, min_size=1, max_size=40))
def test_clean_text_matches_definition(spark, values):
    assert run(spark, values, clean_text) == [per_value(v) for v in values]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=12), min_size=1, max_size=40))
def test_clean_text_on_mojibake(spark, blobs):
    values = [b.decode("cp1252", errors="ignore") for b in blobs]
    assert run(spark, values, clean_text) == [per_value(v) for v in values]


def test_blank_as_null(spark):
    assert run(spark, ["", "   ", "\t\n", " a ", None], blank_as_null) == [None, None, None, " a ", None]


def per_byte(data: bytes, width: int | None = None) -> str:
    """Bytes that are no part of a UTF-8 sequence become '?', then whole characters are kept up to the width."""
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at:at + n].decode())
                break
            except UnicodeDecodeError:
                pass
        else:
            n = 1
            out.append("?")
        at += n
    ends = list(itertools.accumulate(len(c.encode()) for c in out))
    return "".join(c for c, end in zip(out, ends) if not width or end <= width)


ODD_BYTES = [b"plain", b"", b"caf\xe9 x", b"\xe2\x82", b"\xe2\x82\xac", b"\xed\xa0\x80\xed\xb0\x80", b"\xef\xbf\xbd", b"\xff\xfe\x80a",
             b"\xc0\xaf", b"\xf0\x9f\x98\x80!", b"\xf0\x9f\x98", b"\xf5\x80\x80\x80", "日本語 é".encode(), b"a" * 200_000 + b"\xe9" + "é".encode() * 100_000]


@pytest.mark.parametrize("width", [None, 1, 2, 3, 4, 7, 100_001])
def test_bytes_are_replaced_and_cut_one_by_one(spark, width):
    """A genuine U+FFFD stays; each stray byte is one '?'; a width is in bytes and never splits a character."""
    texts = [b.decode("iso-8859-1") for b in ODD_BYTES]
    got = run(spark, [*texts, None], lambda c: from_bytes(truncate_bytes(accept_invalid_bytes(c), width)))
    assert got == [*[per_byte(b, width) for b in ODD_BYTES], None]


@given(st.lists(st.binary(max_size=12), min_size=1, max_size=20), st.integers(1, 9))
@settings(max_examples=15, deadline=None)
def test_any_bytes(spark, values, width):
    texts = [b.decode("iso-8859-1") for b in values]
    got = run(spark, texts, lambda c: from_bytes(truncate_bytes(accept_invalid_bytes(c), width)))
    assert got == [per_byte(b, width) for b in values]
