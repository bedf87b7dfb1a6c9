"""Quality classifier by supervised subword embeddings.

Every word, every pair of adjacent words and every run of 3 or 4 characters
inside a word (with the white space on its sides) is hashed to a learned
vector.  A pair of equal words has one hash, whatever the word.  A document is
the average of its vectors (words, pairs and character runs weigh alike, however
many there are of each), and a softmax layer turns that into the probability of
label 1.  Vectors and layer are trained together by numpy stochastic gradient
descent on a bounded sample of labelled rows.

As the layer is linear, a document's score needs only one number per hash
(the vector's part of the difference of the two outputs) averaged over the
document: 256 KB of weights go to the tasks, and a text is read once.

Bounds: at most ``sample_rows`` labelled documents with at most
``sample_features`` different hashes in all are trained on, chosen by the hash
of their id over all labelled rows; their counts (not their texts) come to the
driver.  Everything else covers all rows and whole texts.  Long texts are
taken in pieces cut between words, of about ``PIECE`` characters.

Defined results: a null, empty or blank text has no vector and gets the
sample's share of label 1; without any usable label every score is 0.5; a row
without an id is not held out and has no label; ids whose labels differ, or
are neither 0 nor 1, are not learned from; of rows that share a labelled id one
is learned from; a word of over ``PIECE`` characters is taken in parts; equal
texts have equal scores; an empty table gives an empty result; extra columns of the
tables play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warehaus.llm.common import small_batches, stored

BUCKETS_LOG = 16
DIM = 16
EPOCHS = 6
RATE = 3.0
LAYER_RATE = 0.1  # every document moves the layer, few move a vector
DAMP = 0.02  # steps are divided by the squared length of what they multiply, here plus this
SEED = 13
SAMPLE_ROWS = 4_000
SAMPLE_FEATURES = 8_000_000
PIECE = 1 << 17
GRAMS = (3, 4)
KINDS = 3  # words, pairs, character runs
THRESHOLD = 0.3

#: Odd multipliers of the hashes: any would do.
STEP = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9
AGAIN = 0x94D049BB133111EB
SPACE = 32


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ---------------------------------------------------------------- features

def cuts(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at white space where there is some."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end > at and text[end] not in " \t\n\v\f\r":
            end -= 1
        end = end if end > at else at + size
        yield text[at:end]
        at = end
    yield text[at:]


class Hasher:
    """Hashed features of texts; keeps the powers of the rolling hash."""

    def __init__(self, buckets_log: int = BUCKETS_LOG):
        self.shift = np.uint64(64 - buckets_log)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            one = np.ones(1, np.uint64)
            self.power = np.cumprod(np.concatenate([one, np.full(n, STEP, np.uint64)]))
            self.inverse = np.cumprod(np.concatenate([one, np.full(n, pow(STEP, -1, 1 << 64), np.uint64)]))

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
        return ((h ^ (h >> np.uint64(29))) * np.uint64(STEP) >> self.shift).astype(np.int64)

    def features(self, texts: list[str], before: int | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], int | None]:
        """(hash, index of the text) of every word, pair and character run, and the last word's hash.

        ``before`` is the hash of the word before the first text, where that continues another.
        """
        code = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le"), np.uint32)
        blank = (code == SPACE) | ((code >= 9) & (code <= 13))
        code = np.where(blank, SPACE, code).astype(np.uint64)
        n = len(code)
        self._grow(n + 1)
        owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
        owner = np.concatenate([[0], owner])
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        if not len(starts):
            return [], before
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * self.power[:n])])
        word = (run[ends] - run[starts]) * self.inverse[starts]
        whose = owner[starts]
        left, right, mine = word[:-1], word[1:], whose[1:]
        together = whose[:-1] == mine
        if before is not None:
            left, right = np.concatenate([np.array([before], np.uint64), left]), word
            mine, together = whose, np.concatenate([whose[:1] == 0, together])
        pair = np.where(left == right, np.uint64(AGAIN), left * np.uint64(MIX) + right * np.uint64(AGAIN))
        found = [(self._bucket(word), whose), (self._bucket(pair[together]), mine[together])]
        runs, of = [], []
        gram = code * np.uint64(STEP) + np.uint64(1)
        for size in range(2, max(GRAMS) + 1):
            if n < size:
                break
            gram = gram[:n - size + 1] * np.uint64(STEP) + code[size - 1:] + np.uint64(1)
            if size in GRAMS:
                inner = ~blank[1:n - size + 2]
                for j in range(2, size - 1):
                    inner &= ~blank[j:n - size + 1 + j]
                at = np.flatnonzero(inner)
                runs.append(self._bucket(gram[at]))
                of.append(owner[at + 1])
        return [*found, (np.concatenate(runs), np.concatenate(of))], int(word[-1])

    def batches(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, hashes, indexes of the texts) of all texts, about ``PIECE`` characters at a time."""
        held, where, size = [], [], 0

        def flush():
            found, _ = self.features(held)
            for kind, (ids, of) in enumerate(found):
                yield kind, ids, np.asarray(where)[of]

        for i, text in enumerate(texts):
            if not text:
                continue
            if len(text) > PIECE:
                last = None
                for piece in cuts(text):
                    found, last = self.features([piece], last)
                    for kind, (ids, of) in enumerate(found):
                        yield kind, ids, of + i
                continue
            held.append(text)
            where.append(i)
            size += len(text)
            if size >= PIECE:
                yield from flush()
                held, where, size = [], [], 0
        if held:
            yield from flush()


# ---------------------------------------------------------------- training

def train(counts: list[tuple[np.ndarray, np.ndarray, int]], buckets_log: int = BUCKETS_LOG, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, float]:
    """(weight of every hash, bias) of the log odds of label 1, from (hashes, shares, label) per document.

    The output layer starts at the log odds of the sample, so a document without features scores its share of label 1.
    """
    rng = np.random.default_rng(seed)
    share = (sum(y for *_, y in counts) + 0.5) / (len(counts) + 1)
    bias = np.log([1 - share, share])
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << buckets_log, dim)).astype(np.float32)
    layer = rng.normal(0, dim ** -0.5, (dim, 2)).astype(np.float32)
    steps, done = epochs * len(counts), 0
    for _ in range(epochs):
        for i in rng.permutation(len(counts)):
            ids, part, label = counts[i]
            lr = rate * (1 - done / steps)
            done += 1
            if not len(ids):
                continue
            seen = vectors[ids]
            mean = part @ seen
            out = mean @ layer + bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[label] -= 1
            p = p.astype(np.float32)
            back = layer @ p
            vectors[ids] = seen - np.float32(lr / (DAMP + part @ part) / np.square(layer).sum()) * part[:, None] * back
            layer -= np.float32(lr * LAYER_RATE / (1 + mean @ mean)) * np.outer(mean, p)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str,
           sample_rows: int, sample_features: int, buckets_log: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Feature shares and label of the documents to learn from."""
    known = labels.where(labels[label_id].isNotNull() & labels[label_col].isNotNull()).groupBy(labels[label_id].alias("id")) \
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("most")).where("label = most and label in (0, 1)")
    order = F.xxhash64("id", F.lit(SEED))
    chosen = docs.select(docs[id_col].alias("id")).where(~held_out(F.col("id"))).distinct().join(known, "id")
    chosen = stored(chosen.orderBy(order, "id").limit(sample_rows).select("id", F.col("label").cast("int").alias("label")), "quality-sample")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(chosen), "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(buckets_log)
        for batch in batches:
            for k in range(batch.num_rows):
                total = np.zeros((KINDS, 1 << buckets_log))
                for kind, ids, _ in hasher.batches([batch["text"][k].as_py()]):
                    total[kind] += np.bincount(ids, minlength=1 << buckets_log)
                parts = total.sum(axis=1)
                total = (total / np.maximum(parts, 1)[:, None]).sum(axis=0) / max(1, np.count_nonzero(parts))
                ids = np.flatnonzero(total)
                share = total[ids].astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(k, 1), batch["label"].slice(k, 1), pa.array([ids.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([share.tobytes()], pa.binary()), pa.array([len(ids)], pa.int64())],
                    names=["id", "label", "ids", "shares", "n"])

    kind = dict(docs.dtypes)[id_col]
    one = rows.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("id", "label", "t.text")
    counted = stored(one.mapInArrow(count, f"id {kind}, label int, ids binary, shares binary, n long"), "quality-sample")
    out, features = [], 0
    for r in counted.orderBy(order, "id").toLocalIterator():
        features += r.n
        if features > sample_features:
            break
        out.append((np.frombuffer(r.ids, np.int32), np.frombuffer(r.shares, np.float32), r.label))
    return out


# ---------------------------------------------------------------- scoring

def score(df: DataFrame, model: tuple[np.ndarray, float], text_col: str, keep: list[str], buckets_log: int = BUCKETS_LOG) -> DataFrame:
    """Columns ``keep`` of every row, and the probability of label 1."""
    spark = df.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast((model[0].astype(np.float32), model[1]))  # 4 bytes a bucket
    rows = df.select(*keep, df[text_col].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = sent.value
        hasher = Hasher(buckets_log)
        for batch in batches:
            n = batch.num_rows
            total, count = np.zeros((KINDS, n)), np.zeros((KINDS, n))
            for kind, ids, of in hasher.batches(batch["_text"].to_pylist()):
                total[kind] += np.bincount(of, weights=weight[ids], minlength=n)
                count[kind] += np.bincount(of, minlength=n)
            kinds_in = np.maximum(np.count_nonzero(count, axis=0), 1)
            odds = (total / np.maximum(count, 1)).sum(axis=0) / kinds_in + bias
            p = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], names=[*keep, "score"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "score double"]))


def evaluate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
             label_col: str = "quality", threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS,
             sample_features: int = SAMPLE_FEATURES, buckets_log: int = BUCKETS_LOG) -> DataFrame:
    """Learn from the labelled rows that are not held out; doc_id, held_out, score, predicted for all rows."""
    known = sample(docs, labels, id_col, text_col, label_id, label_col, sample_rows, sample_features, buckets_log)
    model = train(known, buckets_log) if known else (np.zeros(1 << buckets_log), 0.0)
    base = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), held_out(docs[id_col]).alias("held_out"))
    return score(base, model, "text", ["doc_id", "held_out"], buckets_log) \
        .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
