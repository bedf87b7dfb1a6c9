"""Merkle manifest, conversation trie and quality classifier: against brute force, and on odd input."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from warehaus.llm import merkle, quality, tries
from warehaus.llm.queries import queries

CLASHES = {"place": "p", "pos": 1, "digest": "d", "n": 2, "leaf": "l", "root": "r", "suffix": "s", "block": 3, "tie": 4, "changed": "c",
           "key": "k", "seg": 5, "depth": 6, "item": "i", "words": 7, "h": 8, "base": 9, "taken": 1, "label": 0, "score": 0.1, "id": 3}


def clashing(df):
    for name, value in CLASHES.items():
        df = df.withColumn(name, F.lit(value))
    return df


# ------------------------------------------------------------ Merkle manifest

def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def brute_tree(nodes):
    """Levels of the tree over the nodes, from themselves to the one that remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha(*row[i:i + 2]) for i in range(0, len(row), 2)])
    return levels


def brute_manifest(rows):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, lang, s, n: sha(*map(part, (i, s, lang, n, t)))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = brute_tree([leaf(*r) for r in groups[g]])
    upper = brute_tree([trees[g][-1][0] for g in order])
    root = upper[-1][0] if order else None
    out = []
    for k, g in enumerate(order):
        for p, r in enumerate(groups[g]):
            steps = []
            for at, levels in ((p, trees[g]), (k, upper)):
                for row in levels[:-1]:
                    steps.append((at & 1, row[at ^ 1] if at ^ 1 < len(row) else None))
                    at >>= 1
            own = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                own = leaf(*r[:4], r[4] + 1)
            for right, beside in steps:
                own = sha(own) if beside is None else sha(beside, own) if right else sha(own, beside)
            out.append((r[0], leaf(*r), trees[g][-1][0], root, sha(*[b for _, b in steps if b]), own, own == root))
    return Counter(out)


def manifest_of(spark, rows, clash=False, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = clashing(df) if clash else df
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return Counter(tuple(r) for r in merkle.manifest(df, tamper=tampered, **how).collect())


ODD = [(i, f"text {i}", ("en", "de", None, "日本", "é")[i % 5 if i % 3 else 0], "s", i) for i in range(70)] + [
    (None, None, None, None, None), (None, "x", "en", None, 3), (7, "", "fr", "", None), (7, "", "fr", "", None), (7, None, "fr", "", None),
    (8, "long " * 100_000, "de", "s", 2**63 - 1), (21, "é", "", "s", -4), (0, "only", "solo", "s", 1), (49, None, "en", "s", None)]


@pytest.mark.parametrize("height", [1, 2, 12])
def test_manifest_equals_brute_force_for_every_block_height(spark, height):
    assert manifest_of(spark, ODD, clash=height == 2, height=height) == brute_manifest(ODD)


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", "s", 1)], [(i, "same", "en", "s", 4) for i in [5] * 9],
                                  [(i, "x", f"l{i:02}", "s", 1) for i in range(9)]], ids=["empty", "one", "repeats", "languages"])
def test_manifest_of_small_tables(spark, rows):
    assert manifest_of(spark, rows, height=2) == brute_manifest(rows)


def test_proofs_fold_to_the_root(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    for r in merkle.manifest(df, height=3, with_proof=True).collect():
        assert merkle.fold(r.leaf, r.proof) == r.root and r.verified
        assert merkle.fold(sha("other"), r.proof) != r.root


def test_tampering_is_found(spark):
    got = manifest_of(spark, ODD)
    tampered = [i for i, *_, ok in got.elements() if not ok]
    assert tampered and all(zlib.crc32(str(i).encode()) % 7 == 0 for i in tampered)


# ------------------------------------------------------------ conversation trie

def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha(str(len(role.encode())), ":", role, text), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(int(c - (abs(c) % 20) * (1 if c >= 0 else -1)), [])[:h] + turns[h:]
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[:d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        own_saved = (len(m) - 1) * len(node[-1][1].split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own_saved
            leaves[node[:d]] += node not in kids
    return Counter((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]) if node in kids else 0,
                    leaves[node], saved[node], sha(",".join(map(str, sorted(ends[node]))))) for node, m in members.items())


def trie_of(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return Counter(tuple(r) for r in tries.prefix_trie(tries.rebuilt(clashing(df) if clash else df)).collect())


def some_conversations(seed):
    rng = random.Random(seed)
    texts = ["a b", "c", "", None, "d e f"]
    return [(c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(texts))
            for c in rng.sample(range(-60, 160), 90) for t in range(rng.choice([1, 1, 2, 3, 5, 9]))]


@pytest.mark.parametrize("rows", [
    some_conversations(1), some_conversations(2),
    [], [(1, 0, "user", "alone")],
    [(None, 0, "user", "x"), (3, None, None, None), (3, None, None, None), (23, 1, "user", "x " * 100_000)],
    [(c, t, "user", f"turn {t}") for c in range(20, 40) for t in range(c - 19)],  # each continues the one before
    [(c, t, "user", "same") for c in range(40, 70) for t in range(6)],
], ids=["random", "random2", "empty", "one", "nulls", "nested", "copies"])
def test_trie_equals_brute_force(spark, rows):
    assert trie_of(spark, rows, clash=len(rows) == 4) == brute_trie(rows)


def test_long_conversations_are_taken_in_segments(spark, monkeypatch):
    monkeypatch.setattr(tries, "SEGMENT_BITS", 3)
    monkeypatch.setattr(tries, "IDS_A_PIECE", 4)
    rows = [(c, t, "user", f"t {min(t, 40 + c)}") for c in (20, 21, 40, 55) for t in range(70)] + \
        [(c, t, "user", f"t {t}") for c in range(200, 230) for t in range(5)]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_totals_of_a_random_tree(spark):
    """Contraction alone, on a tree with long unary chains and a hot node."""
    rng = random.Random(5)
    parent = [None, *[max(0, i - 1) if rng.random() < 0.8 else rng.randrange(0, i) for i in range(1, 300)], *[7] * 100]
    kids, total = Counter(parent), [i % 11 for i in range(len(parent))]
    rows = [(i, p, kids[i], i % 11, 1) for i, p in enumerate(parent)]
    size = [1] * len(parent)
    for i in reversed(range(1, len(parent))):
        if i < 300:
            continue
        total[7] += total[i]
        size[7] += 1
    for i in reversed(range(1, 300)):
        total[parent[i]] += total[i]
        size[parent[i]] += size[i]
    got = tries.subtree_totals(spark.createDataFrame(rows, "id long, parent long, kids long, v long, n long"), ["v", "n"])
    assert {r.id: (r.v, r.n) for r in got.collect()} == {i: (total[i], size[i]) for i in range(len(parent))}


# ------------------------------------------------------------ quality classifier

def brute_features(text):
    """Every feature of a text, by plain string work: words, pairs and character runs."""
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
    pairs = ["again" if a == b else (a, b) for a, b in zip(words, words[1:])]
    grams = [f" {w} "[i:i + k] for w in words for k in quality.GRAMS for i in range(len(w) + 3 - k)]
    return [Counter(words), Counter(pairs), Counter(grams)]


def hashed(texts):
    got = defaultdict(lambda: [Counter() for _ in range(quality.KINDS)])
    for kind, ids, of in quality.Hasher().batches(texts):
        for i, t in zip(ids.tolist(), of.tolist()):
            got[t][kind][i] += 1
    return got


def test_features_equal_brute_force(monkeypatch):
    texts = ["one two two  three\nfour", "", None, "  \t", "x", "ça va très bien 中文 \U0001f600", "aa aa aa", "tail\x0bword "]
    names = {}
    for size in (1 << 17, 5):
        monkeypatch.setattr(quality, "PIECE", size)
        got = hashed(texts)
        for t, text in enumerate(texts):
            want = brute_features(text or "")
            assert [sorted(c.values()) for c in got[t]] == [sorted(c.values()) for c in want], text
            if size > 5:
                names[t] = got[t]
            else:
                assert got[t] == names[t], text


def test_cuts_lose_nothing():
    text = "ab cde\n" * 50 + "x" * 30
    assert "".join(quality.cuts(text, 16)) == text


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    got = queries()["op13_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    rows = got.select("quality", "predicted", "score").collect()
    assert len(rows) > 500
    right = sum(r.quality == r.predicted for r in rows) / len(rows)
    low, high = ([r.score for r in rows if r.quality == q] for q in (0, 1))
    assert right > 0.98
    assert np.mean([x < y for x in low for y in high]) > 0.98


def quality_of(spark, docs, labels, clash=False):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return [tuple(r) for r in quality.evaluate(clashing(df) if clash else df, known).collect()]


def test_quality_on_odd_input(spark):
    good, bad = "plain and good words in a row", "### $$$ %%% &&& ***"
    docs = [(i, good if i % 2 else bad) for i in range(60)] + [
        (None, good), (61, None), (62, ""), (63, " \n"), (64, bad + " "), (65, "word " * 60_000), (65, "y" * 300_000), (1, good), (1, bad)]
    labels = [(i, i % 2, 0) for i in range(60)] + [(2, 1, 0), (3, 1, 0), (None, 0, 0), (4, None, 0), (62, 7, 0), (900, 1, 0)]
    got = quality_of(spark, docs, labels, clash=True)
    assert sorted((r[0] is not None, r[0] or 0) for r in got) == sorted((i is not None, i or 0) for i, _ in docs)
    assert all(0 <= s <= 1 and p == (s >= 0.3) for _, _, s, p in got)
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, h, *_ in got)
    by_text = defaultdict(set)
    for (i, _, s, p) in got:
        if i is not None and i < 60 and i != 1:
            by_text[i % 2].add((round(s, 12), p))
    assert [len(by_text[k]) for k in (0, 1)] == [1, 1]
    assert {p for _, p in by_text[0]} == {0} and {p for _, p in by_text[1]} == {1}
    blank = {s for i, _, s, _ in got if i in (61, 62, 63)}
    assert len(blank) == 1 and 0.3 < blank.pop() < 0.7


def test_quality_without_labels_or_rows(spark):
    assert quality_of(spark, [(1, "a"), (2, None)], []) == [(1, False, 0.5, 1), (2, False, 0.5, 1)]
    assert quality_of(spark, [], [(1, 1, 0)]) == []
    assert all(s > 0.5 for _, _, s, _ in quality_of(spark, [(i, "a b") for i in range(9)], [(i, 1, 0) for i in range(9)]))


def test_the_labels_of_held_out_rows_change_nothing(spark):
    docs = [(i, ("good words here " if i % 3 else "!!! ??? ") * (i % 5 + 1)) for i in range(80)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(80)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, q, _ in labels]
    assert sorted(quality_of(spark, docs, labels)) == sorted(quality_of(spark, docs, turned))
