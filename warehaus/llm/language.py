"""Language identification by cross-parsing entropy.

For every language of a labelled sample a suffix automaton accepts all
substrings of its text.  A text is cross-parsed against each automaton: the
longest match from the current place is one phrase, and the parse goes on
behind it.  c phrases against a sample of N characters cost c * log2(N) bits;
divided by the text's length this estimates the cross entropy.  N is the
length of the largest sample for all languages, and also the price of a
character that a sample lacks: a language with little labelled text does not
win by cheap phrases.  The price being the same, the language that needs the
fewest phrases wins (ties: the language first in order of code points).

The parse runs over the letters: lower-cased runs of letters, each between two
spaces, are parsed one by one, so a phrase does not cross a word's end.  The
words of a batch are parsed side by side, one array step per character.

The sample is bounded: of the ``MOST_LANGUAGES`` languages with most labelled
rows, per language, about ``sample_rows`` labelled rows picked
by a hash, and of their distinct words (those in most rows first)
``sample_chars`` characters; a word that does not fit is passed over (where
none fits, the first is cut).  Nothing else is capped: every character of
every text is parsed.

Defined results: a text that is null or without a letter is ``und`` with score
0, and so is every text when nothing is labelled; characters that a sample
lacks are phrases of their own; null labels are not learned from; repeated
rows give equal rows; a very long text is parsed whole, word by word; input
columns named like the results are replaced, others are not looked at; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warehaus.llm.common import small_batches

SAMPLE_ROWS = 200
SAMPLE_CHARS = 40_000
MOST_LANGUAGES = 200  # bounds the model that is sent to the tasks
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
MEMO_WORDS = 200_000
SLICE_ROWS = 128


class Automaton:
    """Suffix automaton of a text as a table state x letter -> state (-1: none)."""

    def __init__(self, text: str, letters: dict[str, int]):
        follow: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in follow[p]:
                follow[p][c] = cur
                p = link[p]
            if p >= 0:
                q = follow[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:  # split q: the shorter of its strings get a state of their own
                    twin = len(follow)
                    follow.append(dict(follow[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = link[cur] = twin
                    while p >= 0 and follow[p].get(c) == q:
                        follow[p][c] = twin
                        p = link[p]
            last = cur
        self.table = np.full((len(follow), len(letters) + 1), -1, np.int32)
        for s, to in enumerate(follow):
            for c, t in to.items():
                self.table[s, letters[c]] = t


class Model:
    """Automata of all languages, and the phrase counts of words."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.names = [n for n, _ in samples]
        self.letters = {c: i for i, c in enumerate(sorted({c for _, t in samples for c in t}))}
        self.parts = [Automaton(t, self.letters) for _, t in samples]
        self.memo: dict[str, int] = {}
        self.counts = np.zeros((1024, len(samples)), np.int32)

    def phrases(self, words: list[str]) -> np.ndarray:
        """Phrases of each word (between spaces) in each language."""
        framed = [f" {w} " for w in words]
        size = np.array([len(w) for w in framed])
        order = np.argsort(-size, kind="stable")  # longest first: a step works on a leading part
        get, none = self.letters.get, len(self.letters)
        flat = np.fromiter((get(c, none) for w in framed for c in w), np.int32, int(size.sum()))
        starts = (np.cumsum(size) - size)[order]
        left = size[order]
        out = np.zeros((len(words), len(self.parts)), np.int32)
        for k, part in enumerate(self.parts):
            table, state = part.table, np.zeros(len(words), np.int32)
            count = np.zeros(len(words), np.int32)
            n = len(words)
            for at in range(int(left[0]) if len(left) else 0):
                n = int(np.searchsorted(-left[:n], -at, side="left"))  # words longer than ``at``
                c = flat[starts[:n] + at]
                to = table[state[:n], c]
                fresh = table[0, c]
                stuck = to < 0
                # No longer match: the phrase before ended, a new one starts with this character.
                count[:n] += stuck & (state[:n] > 0)
                to = np.where(stuck, fresh, to)
                count[:n] += to < 0  # a character the sample lacks
                state[:n] = np.where(to < 0, 0, to)
            out[order, k] = count + (state > 0)
        return out

    def forget(self) -> None:
        self.memo, self.counts = {}, np.zeros((1024, len(self.names)), np.int32)

    def rows_of(self, words: list[str]) -> np.ndarray:
        """The rows of ``counts`` that hold the words' phrases."""
        new = [w for w in words if w not in self.memo]
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = words
        if new:
            at = len(self.memo)
            if at + len(new) > len(self.counts):
                grown = np.zeros((2 * (at + len(new)), len(self.parts)), np.int32)
                grown[:at] = self.counts[:at]
                self.counts = grown
            self.counts[at:at + len(new)] = self.phrases(new)
            self.memo.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        words: list[str] = []
        ends = []
        for t in texts:
            found = LETTERS.findall(t.lower()) if t else []
            if any(c.isalpha() for w in found for c in w):  # the pattern also takes figures such as a raised 2
                words += found
            ends.append(len(words))
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not words or not self.names:
            return names, scores
        place: dict[str, int] = {}
        codes = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
        at_rows = self.rows_of(list(place))
        per_word = self.counts[at_rows]
        held = np.zeros((len(words) + 1, len(self.names)), np.int64)
        np.cumsum(per_word[codes], axis=0, out=held[1:])
        at = np.array([0, *ends])
        count = held[at[1:]] - held[at[:-1]]
        best = count.argmin(axis=1)
        for i in np.flatnonzero(at[1:] > at[:-1]):
            names[i] = self.names[best[i]]
            rest = np.delete(count[i], best[i])
            scores[i] = float(1 - count[i, best[i]] / rest.min()) if len(rest) else 1.0
        return names, scores


@cache
def load(samples: tuple[tuple[str, str], ...]) -> Model:
    return Model(samples)


def sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS,
           chars: int = SAMPLE_CHARS) -> tuple[tuple[str, str], ...]:
    """(language, text of distinct words) per language, both bounds applied.

    The hash threshold that admits about ``rows`` rows of a language comes
    from its count, so each language's sample is gathered without a sort.
    """
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = [r for r in known.groupBy(F.col(lang_col).alias("lang")).count()
              .orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()]
    if not counts:
        return ()
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(rows / r["count"]))])
    part = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 20)) / F.lit(float(1 << 20))
    some = known.where(part < F.element_at(share, F.col(lang_col)))
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit(r"(\p{L}+)"), F.lit(1))))
    words = some.select(F.col(lang_col).alias("lang"), word.alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    line = words.withColumn("h", F.xxhash64("word")).repartition("lang").sortWithinPartitions("lang", F.desc("n"), "h", "word")

    def fit(batches: Iterator) -> Iterator:
        """The words of each language that fit, in order; at most ``chars`` characters a language are collected."""
        import pyarrow as pa
        now = first = None
        at = used = 0
        out: list[tuple] = []
        for batch in batches:
            for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang != now:
                    if now is not None and not used:
                        out.append((now, 0, first[:chars - 1]))
                    now, first, at, used = lang, word, 0, 0
                if used + len(word) + 1 <= chars:
                    out.append((lang, at, word))
                    at, used = at + 1, used + len(word) + 1
        if now is not None and not used:
            out.append((now, 0, first[:chars - 1]))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()),
                                          pa.array([r[2] for r in out], pa.string())], ["lang", "at", "word"])

    by: dict[str, list] = {}
    for r in line.select("lang", "word").mapInArrow(fit, "lang string, at long, word string").collect():
        by.setdefault(r["lang"], []).append((r["at"], r["word"]))
    return tuple((lang, f" {' '.join(w for _, w in sorted(ws))} ") for lang, ws in sorted(by.items()))


def identify(df: DataFrame, samples: tuple[tuple[str, str], ...], text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``df`` (default: all) with ``lang_pred`` and ``score``.

    ``score`` is how much shorter the winner's parse is than the second's (0 to 1).
    Input columns with those two names are replaced.
    """
    small_batches(df.sparkSession)
    names = [c for c in (keep if keep is not None else df.columns) if c not in ("lang_pred", "score")]
    rows = df.select(*[df[c] for c in names], df[text_col].alias("__text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "__text") + ", lang_pred string, score double"
    sent = df.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        model = load(sent.value)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    langs, scores = model.predict(part.column(part.num_columns - 1).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(i) for i in range(len(names))] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                        names + ["lang_pred", "score"])
        finally:
            model.forget()  # workers live on after the task

    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def evaluate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out; doc_id, held_out, lang_pred, score for all."""
    base = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"), df[lang_col].alias("lang"),
                     held_out(df[id_col]).alias("held_out"))
    known = sample(base.where(~F.col("held_out")), "doc_id", "text", "lang")
    return identify(base, known, "text", ["doc_id", "held_out"])
