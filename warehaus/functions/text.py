"""Text cleaning at extract and the text options of the tolerant stage load.

``clean_text`` reproduces, as one native column expression, the per-value
helper used when source rows are written to landing CSV: NULL becomes the
empty string; a string is encoded as windows-1252 dropping characters that
have no code there, and the bytes are decoded as UTF-8 dropping invalid
sequences.  The effect is to repair UTF-8 mojibake and to drop accented
letters that were never mis-encoded.

Steps: (1) drop the C1 controls U+0080-U+009F (windows-1252 has other
characters at those bytes); (2) map the 27 windows-1252 characters of bytes
0x80-0x9F onto the code points of those bytes; (3) drop everything above
U+00FF, so each remaining character is exactly one ISO-8859-1 byte;
(4) encode ISO-8859-1 and reinterpret the bytes as UTF-8; (5) replace
invalid sequences and remove the replacement characters.  A replacement
character spelled by valid bytes (EF BF BD) is genuine data and kept: the
text is split on it before step 4 and rejoined with it.  Steps 1-3 use only
plain ranges and a character map, which run an order of magnitude faster
than one character class listing the 27 exceptions.  No step changes an
ASCII text, so one is passed through after a single test.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Windows-1252 bytes 0x80-0x9F that have a character (0x81, 0x8D,
# 0x8F, 0x90 and 0x9D have none), and their characters, in byte order.
CP1252_HIGH_BYTES = (0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C,
                     0x8E, 0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B,
                     0x9C, 0x9E, 0x9F)
CP1252_HIGH_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"

REPLACEMENT = "�"
# ASCII whitespace: space, tab, newline, vertical tab, form feed, return.
WHITE = " \t\n\x0b\f\r"
# The replacement character as it reads after a UTF-8 -> windows-1252 mix-up.
REPLACEMENT_MOJIBAKE = "ï¿½"

_BYTE_CHARS = "".join(chr(b) for b in CP1252_HIGH_BYTES)


def _as_bytes_text(c: Column) -> Column:
    """Steps 1-3: one character per windows-1252 byte."""
    no_c1 = F.regexp_replace(c, "[\\x{80}-\\x{9F}]+", "")
    mapped = F.translate(no_c1, CP1252_HIGH_CHARS, _BYTE_CHARS)
    return F.regexp_replace(mapped, "[^\\x{0}-\\x{FF}]+", "")


def _decode_piece(c: Column) -> Column:
    """Steps 4-5 on text without an embedded EF BF BD sequence."""
    raw = F.encode(c, "ISO-8859-1").cast("string")
    return F.replace(F.make_valid_utf8(raw), F.lit(REPLACEMENT), F.lit(""))


def clean_text(c: Column) -> Column:
    pieces = F.split(_as_bytes_text(c), REPLACEMENT_MOJIBAKE, -1)
    repaired = F.array_join(F.transform(pieces, _decode_piece), REPLACEMENT)
    return F.coalesce(F.when(~c.rlike("[^\\x{0}-\\x{7F}]"), c).otherwise(repaired), F.lit(""))


def blank_as_null(c: Column) -> Column:
    """Empty or whitespace-only text -> NULL (EMPTYASNULL + BLANKSASNULL)."""
    return F.when(F.ltrim(c, F.lit(WHITE)) == "", F.lit(None).cast("string")).otherwise(c)


# The well-formed UTF-8 sequences, one ISO-8859-1 character per byte.
UTF8_SEQUENCE = ("[\\x{0}-\\x{7F}]|[\\x{C2}-\\x{DF}][\\x{80}-\\x{BF}]|\\x{E0}[\\x{A0}-\\x{BF}][\\x{80}-\\x{BF}]"
                 "|[\\x{E1}-\\x{EC}\\x{EE}\\x{EF}][\\x{80}-\\x{BF}]{2}|\\x{ED}[\\x{80}-\\x{9F}][\\x{80}-\\x{BF}]"
                 "|\\x{F0}[\\x{90}-\\x{BF}][\\x{80}-\\x{BF}]{2}|[\\x{F1}-\\x{F3}][\\x{80}-\\x{BF}]{3}"
                 "|\\x{F4}[\\x{80}-\\x{8F}][\\x{80}-\\x{BF}]{2}")
HIGH = "[\\x{80}-\\x{FF}]"


def accept_invalid_bytes(c: Column, replacement: str = "?") -> Column:
    """Byte text (one ISO-8859-1 character per byte) with every byte outside a UTF-8 sequence replaced (ACCEPTINVCHARS).

    A match is the longest run of whole sequences from where the last one
    ended, and the byte that breaks it; possessive, so its cost is linear.
    """
    return F.when(c.rlike(HIGH), F.regexp_replace(c, f"\\G((?:{UTF8_SEQUENCE})*+){HIGH}", "$1" + replacement)).otherwise(c)


def truncate_bytes(c: Column, width: int | None) -> Column:
    """Byte text of whole sequences cut to a width in bytes, back to a character's start (TRUNCATECOLUMNS)."""
    if not width:
        return c
    cut = F.substring(c, 1, int(width))
    inside = F.substring(c, int(width) + 1, 1).rlike("[\\x{80}-\\x{BF}]")
    return F.when(inside, F.regexp_replace(cut, "[\\x{C0}-\\x{FF}][\\x{80}-\\x{BF}]*$", "")).otherwise(cut)


def from_bytes(c: Column) -> Column:
    """Byte text of whole sequences -> the text they spell."""
    return F.when(c.rlike(HIGH), F.encode(c, "ISO-8859-1").cast("string")).otherwise(c)
