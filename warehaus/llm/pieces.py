"""SentencePiece encoding and decoding.

The pieces of a SentencePiece model form an Aho-Corasick automaton.  One pass
over the text reports, at every position, the pieces that end there (the
automaton follows its output links, longest first); each relaxes the best
score of that position, and the best path read back is the segmentation with
the largest sum of piece scores.  A character that no piece covers is written
as its UTF-8 byte pieces, at a cost below any piece.

This is the segmentation of SentencePiece's unigram kind.  A model marked as
BPE can be given too (its scores are minus the merge rank); its ids then equal
those of the library for the same model marked as unigram, not the greedy
merges, and decode to the same text.

No piece has a word mark after another character, so a best path breaks before
every word mark; the pass runs word by word and a bounded memo keeps the ids
of words already seen (a full memo becomes the older of two generations).  Where a model breaks that rule, whole texts are passed.

Defined results: null and empty texts have no ids; texts of any length are
encoded whole; repeated rows give equal rows; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from warehaus.llm.common import small_batches

MARK = "▁"  # fixed value: SentencePiece's word mark
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MEMO_WORDS = 150_000  # in each of the two generations
SLICE_ROWS = 128
UNKNOWN_COST = 10.0  # fixed value: the library's penalty below the least score


class Pieces:
    """A loaded model; encodes and decodes single texts."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.automaton = ahocorasick.Automaton()
        self.surface: list[bytes] = []
        self.bytes_at: dict[int, int] = {}
        self.unknown = sp.unk_id()
        least, self.inner_mark, letters = 0.0, False, set()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_at[int(piece[1:-1], 16)] = i
                self.surface.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.surface.append(b"")
            else:
                self.surface.append(piece.encode())
                score = sp.get_score(i)
                least = min(least, score)
                self.inner_mark |= MARK in piece.lstrip(MARK)
                letters.update(piece)
                self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.unknown_score = least - UNKNOWN_COST
        # A line break is a word's end too where no piece holds one.
        stop = MARK if "\n" in letters else f"{MARK}\n"
        self.words = re.compile(f"{MARK}*[^{stop}]+|{MARK}+|\n+")
        self.letters = frozenset(x for x in letters if self.automaton.exists(x))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> list[int]:
        """Viterbi over one word: best[e] is the best score of a path ending at e, size and piece its last step."""
        n = len(word)
        best, size, piece = [0.0] + [-math.inf] * n, [0] * (n + 1), [0] * (n + 1)
        if self.letters.issuperset(word):  # then every place is reached by pieces
            for end, (length, score, i) in self.automaton.iter(word):
                total = best[end + 1 - length] + score
                if total > best[end + 1]:
                    best[end + 1], size[end + 1], piece[end + 1] = total, length, i
        else:
            ends: list[list] = [[] for _ in word]
            for end, step in self.automaton.iter(word):
                ends[end].append(step)
            for at, c in enumerate(word):
                steps = ends[at] if c in self.letters else [*ends[at], (1, self.unknown_score, None)]
                for length, score, i in steps:
                    total = best[at + 1 - length] + score
                    if total > best[at + 1]:
                        best[at + 1], size[at + 1], piece[at + 1] = total, length, i
        ids: list[int] = []
        while n:
            if piece[n] is None:
                raw = word[n - 1].encode("utf-8", "surrogatepass")
                ids += [self.bytes_at.get(b, self.unknown) for b in reversed(raw)] if self.bytes_at else [self.unknown]
            else:
                ids.append(piece[n])
            n -= size[n]
        ids.reverse()
        return ids

    def forget(self) -> None:
        self.memo, self.older = {}, {}

    def _kept(self, word: str) -> bytes:
        """The word's ids as 32-bit integers, from the older generation or computed, and kept."""
        if (ids := self.memo.get(word)) is not None:
            return ids
        if (ids := self.older.get(word)) is None:
            ids = array("i", self._word(word)).tobytes()
        if len(self.memo) >= MEMO_WORDS:
            self.older, self.memo = self.memo, {}
        self.memo[word] = ids
        return ids

    def encode_bytes(self, text: str | None) -> bytes:
        """The ids of a text as native 32-bit integers."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        if self.inner_mark:
            return array("i", self._word(marked)).tobytes()
        words = self.words.findall(marked)
        parts = list(map(self.memo.get, words))
        if None in parts:
            parts = [self._kept(w) if x is None else x for w, x in zip(words, parts, strict=True)]
        return b"".join(parts)

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.encode_bytes(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text.removeprefix(" ")


@cache
def load(model_path: str, model: bytes) -> Pieces:
    return Pieces(model)


def _model_bytes(model_path: str) -> bytes:
    with open(model_path, "rb") as f:
        return f.read()


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = DEFAULT_MODEL,
           keep: tuple[str, ...] = (), check: bool = False) -> DataFrame:
    """(doc_id, ids, n_ids) per row, with the ``keep`` columns whose names do not clash.

    With ``check`` each row is decoded again and ``round_trip`` says whether
    the text came back (the word mark itself comes back as a space).  The model
    file is read once on the driver and sent with the task (0.5 MB).
    """
    small_batches(df.sparkSession)
    model = _model_bytes(model_path)
    taken = {id_col, text_col, "doc_id", "ids", "n_ids", "round_trip"}
    rows = df.select(df[id_col].alias("doc_id"), *[df[c] for c in keep if c not in taken], df[text_col].alias("__text"))
    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "__text")
    names = [c for c in rows.columns if c != "__text"]
    extra = ", round_trip boolean" if check else ""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        pieces = load(model_path, model)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    texts = part.column(part.schema.get_field_index("__text")).to_pylist()
                    found = [pieces.encode_bytes(t) for t in texts]
                    size = np.array([len(x) // 4 for x in found])
                    ids = np.frombuffer(b"".join(found), np.int32)
                    cols = [part.column(part.schema.get_field_index(n)) for n in names]
                    cols += [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(ids)),
                             pa.array(size, pa.int64())]
                    if check:
                        cols.append(pa.array([pieces.decode(array("i", x)) == (t or "").replace(MARK, " ")
                                              for x, t in zip(found, texts, strict=True)], pa.bool_()))
                    yield pa.RecordBatch.from_arrays(cols, names + ["ids", "n_ids"] + (["round_trip"] if check else []))
        finally:
            pieces.forget()  # workers live on after the task

    return rows.mapInArrow(run, f"{kept}, ids array<int>, n_ids long{extra}")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str = DEFAULT_MODEL) -> DataFrame:
    """(doc_id, text) from a column of ids; null ids give a null text."""
    small_batches(df.sparkSession)
    model = _model_bytes(model_path)
    rows = df.select(df[id_col].alias("doc_id"), df[ids_col].cast("array<int>").alias("ids"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        pieces = load(model_path, model)
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")
