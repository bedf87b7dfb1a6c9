"""Operators on documents: against brute force, and on nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from warehaus.llm import exact_dedup, jaccard, language, licenses, mixing, pieces

CLASHES = {"keep_id": "k", "kept": "x", "text_sha256": "s", "h": 3, "block": 4, "bits": "b", "maybe": "m", "whole": "w",
           "row": 9, "size": 8, "taken": 7, "target": 1.5, "key": "y", "place": "p", "shard": 2, "signatures": "g", "mark": 1,
           "component_id": 5, "ids": "i", "n_ids": 6, "lang_pred": "q", "score": 0.5, "words": "z", "labels": "l", "id": 12}
LONG = "The long words repeat and vary " * 20_000


def documents(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, value in (CLASHES if clash else {}).items():
        df = df.withColumn(name, F.lit(value))
    return df


MESSY = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 1),
    (2, "alpha beta gamma delta epsilon zeta eta theta", "en", "b", 2),
    (2, "alpha beta gamma delta epsilon zeta eta theta", "en", "b", 2),
    (None, "alpha beta gamma delta epsilon zeta eta theta", None, None, None),
    (4, None, "en", "a", None), (5, "", "de", None, 0), (6, "  \n\t ", "de", "a", 4), (7, "one", "en", "c", 3),
    (None, None, None, None, None), (8, "ONE", "en", "c", 3), (9, LONG, "en", "a", len(LONG)), (10, LONG + "x", "en", "a", 1),
    (11, "ça va très bien 中文 \U0001f600 ▁ done", "fr", "b", 1), (12, "12 34 !!", "en", "a", 1),
]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ------------------------------------------------------------ exact dedup

def brute_exact(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept_once = False
        for i in ids:
            kept = i == keep and not kept_once
            kept_once |= kept
            out[i, keep, len(ids), kept, digest] += 1
    return out


def test_exact_marks_equal_brute_force(spark):
    assert Counter(rows_of(exact_dedup.mark_exact(documents(spark, MESSY, clash=True)))) == brute_exact(MESSY)


def test_exact_filter_of_one_block_still_exact(spark):
    rows = [(i, f"text {i % 700}", "en", "s", 1) for i in range(9000)]
    got = exact_dedup.mark_exact(documents(spark, rows), max_blocks=1)
    assert Counter(rows_of(got)) == brute_exact(rows)


def test_exact_only_possible_repeats_shuffle(spark):
    """A unique row passes straight through unless all its filter cells are shared."""
    rows = documents(spark, [(i, f"unique {i}", "en", "s", 1) for i in range(20_000)]).select(F.xxhash64("text").alias("h"))
    cells, blocks = exact_dedup.repeated_cells(rows, 20_000)
    assert exact_dedup.flagged(rows, cells, blocks).where("maybe").count() < 800


def test_exact_drop_keeps_all_columns(spark):
    df = documents(spark, MESSY, clash=True)
    got = exact_dedup.drop_exact(df)
    assert got.columns == df.columns
    texts = [r.text or "" for r in got.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in MESSY})
    assert {r.doc_id for r in got.collect() if r.text == MESSY[0][1]} == {2}


# ------------------------------------------------------------------ mixing

def test_mixing_meets_its_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 90))), "en", ["a", "b", "c", None, "tiny"][min(4, int(rng.integers(0, 41)) // 10)], 1)
            for i in range(3000)]
    got = [r.asDict() | {"source": rows[r.doc_id][3]} for r in mixing.mix(documents(spark, rows), shard_rows=200).collect()]
    assert len(got) == len(rows)
    size = Counter()
    for i, t, _, s, _ in rows:
        size[s] += len(t.split())
    want = brute_targets(size)
    taken = Counter()
    for r in got:
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(want[r["source"]], abs=1e-5)
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5
    assert any(want[s] == 3 * size[s] for s in size)


@pytest.mark.parametrize("shard_rows", [50_000, 40])
@pytest.mark.parametrize("rows", [
    [(1, "a b", "en", "x", 1), (2, "c", "en", "y", 1), (3, "d e f", "en", "z", 1)],
    [(i, "w " * 10, "en", f"s{i:03}", 1) for i in range(200)],
    [(i, "w " * (i % 4), "en", f"s{i % 23:03}", 1) for i in range(400)] + [(900, "long " * 50_000, "en", "s000", 1)],
], ids=["three", "ten words each", "few words and one long"])
def test_small_sources_get_their_words(spark, rows, shard_rows):
    got = mixing.mix(documents(spark, rows), shard_rows=shard_rows).collect()
    source = {r[0]: r[3] for r in rows}
    taken, target, size = Counter(), {}, Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r.doc_id]] += r["taken"]
        target[source[r.doc_id]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())


def brute_targets(size):
    """Share the total by weight; what exceeds three times a source goes to the others, again and again."""
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(size.values())), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share, left = {s: left * weight[s] / total for s in open_}, 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] >= 3 * size[s]:
                left += target[s] - 3 * size[s]
                target[s] = 3.0 * size[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("seats", [0, 1, 7, 1000])
def test_sainte_lague_equals_highest_quotients(spark, seats):
    votes = [53, 24, 23, 1, 1, 0, 400]
    df = spark.createDataFrame([(0, i, float(v), seats) for i, v in enumerate(votes)], "g int, party int, votes double, seats int")
    got = {r.party: r.won for r in mixing.apportion(df, ["g"], "votes", "seats", "won").collect()}
    want = Counter()
    for _ in range(seats):
        want[max(range(len(votes)), key=lambda i: (votes[i] / (2 * want[i] + 1), votes[i], -i))] += 1
    assert got == {i: want[i] for i in range(len(votes))}


def test_mixing_many_small_parties(spark):
    votes = [100_000] + [4] * 300
    df = spark.createDataFrame([(0, i, float(v), 500) for i, v in enumerate(votes)], "g int, party int, votes double, seats int")
    got = [r.won for r in mixing.apportion(df, ["g"], "votes", "seats", "won").orderBy("party").collect()]
    low, high = 1e-6, 1e9
    for _ in range(200):  # the divisor whose roundings give the seats
        mid = (low + high) / 2
        low, high = (mid, high) if sum(int(v / mid + 0.5) for v in votes) > 500 else (low, mid)
    assert sum(got) == 500 and abs(got[0] - int(votes[0] / high + 0.5)) <= 1


def test_mixing_messy_and_rerun(spark):
    df = documents(spark, MESSY, clash=True)
    a, b = rows_of(mixing.mix(df)), rows_of(mixing.mix(df.repartition(3)))
    assert sorted(a, key=repr) == sorted(b, key=repr) and len(a) == len(MESSY)
    assert mixing.mixed_rows(df).columns == df.columns


# ----------------------------------------------------------------- licences

def test_licence_scan(spark):
    texts = ["CC-BY and CC BY-SA. All   Rights reserved!", "Licensed under CC BY-NC 4.0.", "GNU General Public License, general public license",
             "released under one mit license", "permission granted", None, "", "cc " * 5, "by cc",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of THIS software"]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)], clash=True)).collect()}
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (9, 3, 0, 6, "cc-by,reserved")
    assert got[1].labels == "cc-by,cc-by-nc" and got[1].score == 1.0
    assert got[2].n_base == 2 and got[2].last_word == 4 and "gpl" in got[2].labels
    assert got[3].labels == "mit" and got[3].n_base == 0 and got[3].first_word is None and got[3].score == pytest.approx(0.8)
    assert got[9].labels == "mit"
    for i in (4, 5, 6, 7, 8):
        assert (got[i].n_base, got[i].labels, got[i].base_labels, got[i].score) == (0, "", "", 0.0)
    assert got[5].n_words == got[6].n_words == 0


def test_licence_long_text(spark):
    text = ("x " * 50_000 + "all rights reserved ") * 3
    r = licenses.scan(documents(spark, [(1, text, "en", "a", 1)])).first()
    assert (r.n_base, r.first_word, r.last_word) == (3, 50_000, 150_006)


# ------------------------------------------------------------ SentencePiece

def unigram(model_bytes):
    """The library's own unigram encoder over the same pieces (and the model it reads).

    The whitespace pieces' score of -1e9 is beyond the library's float precision, so both get a mild one.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.ParseFromString(model_bytes)
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.score < -1e6:
            p.score = -40_000
    return m.SerializeToString(), sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def test_pieces_equal_the_library(spark):
    model, library = unigram(pieces._model_bytes(pieces.DEFAULT_MODEL))
    mine = pieces.Pieces(model)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    lines = [x for t in texts for x in (t or "").split("\n")] + ["a  b", "   ", "中文 ça", "x\ty", "", " lead", "trail ", "a" * 500]
    for x in lines:
        assert mine.encode(x) == library.encode(x), x
        assert mine.decode(mine.encode(x)) == library.decode(library.encode(x)) == x


def test_pieces_messy(spark):
    df = documents(spark, MESSY, clash=True)
    got = rows_of(pieces.encode(df, check=True, keep=("lang", "ids", "size")))
    assert len(got) == len(MESSY) and all(r[-1] for r in got)
    by = {r.doc_id: r for r in pieces.encode(df).collect()}
    assert by[4].ids == by[5].ids == [] and by[9].n_ids == len(by[9].ids) > 100_000
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df.where("doc_id is not null"))).collect()}
    assert back[9] == LONG and back[6] == "  \n\t " and back[11] == MESSY[12][1].replace("▁", " ")


def test_pieces_with_inner_marks_pass_whole_texts():
    p = pieces.Pieces(pieces._model_bytes(pieces.DEFAULT_MODEL))
    want = p.encode("the quick the quick")
    p.inner_mark = True
    assert p.encode("the quick the quick") == want


# ------------------------------------------------------------------ Jaccard

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(text, k):
    words = SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < k else frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute_components(rows, k, percent):
    sets = [brute_sets(t, k) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows))


def near_rows(n=260, seed=3):
    """Groups of texts of many lengths, edited so that similarities lie on both sides of the threshold."""
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocab, 40))
    rows, bases = [], []
    for i in range(n):
        kind = rng.integers(0, 4)
        if kind == 0 or not bases:
            words = list(rng.choice(vocab, int(rng.integers(1, 300)))) + (passage if rng.random() < 0.4 else [])
            bases.append(words)
        else:
            words = list(bases[int(rng.integers(0, min(12, len(bases))))])
            for _ in range(int(rng.integers(0, max(1, len(words) // 20) + 1))):
                at = int(rng.integers(0, len(words)))
                words[at:at + int(rng.integers(0, 2))] = list(rng.choice(vocab, int(rng.integers(0, 2))))
                words = words or ["w0"]
        rows.append((i, " ".join(words), "en", "s", 1))
    return rows


@pytest.mark.parametrize("words,percent,block", [(4, 85, 4096), (1, 80, 4096), (5, 80, 3), (2, 50, 7)])
def test_jaccard_components_equal_brute_force(spark, words, percent, block):
    rows = near_rows()
    got = jaccard.join_components(documents(spark, rows), words=words, percent=percent, block=block)
    assert Counter(rows_of(got)) == brute_components(rows, words, percent)


def test_jaccard_messy(spark):
    for k, percent in ((4, 85), (5, 80)):
        got = jaccard.join_components(documents(spark, MESSY, clash=True), words=k, percent=percent)
        assert Counter(rows_of(got)) == brute_components(MESSY, k, percent)


def test_jaccard_threshold_is_met_exactly(spark):
    """17 of 20 shared words link at 85 %, 16 do not."""
    words = [f"x{i}" for i in range(40)]
    rows = [(1, " ".join(words[:17]), "", "", 0), (2, " ".join(words[:20]), "", "", 0),
            (3, " ".join(words[20:36]), "", "", 0), (4, " ".join(words[20:39]), "", "", 0)]
    got = {r.doc_id: r.component_id for r in jaccard.join_components(documents(spark, rows), words=1, percent=85).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_jaccard_hot_group_of_near_copies(spark):
    """A long chain of near copies over several blocks is one component, and costs no pair per link."""
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(900):
        w = list(base)
        w[i % 120] = f"edit{i}"
        rows.append((i, " ".join(w), "en", "hot", 1))
    got = jaccard.join_components(documents(spark, rows), words=4, percent=85, block=128)
    assert {r.component_id for r in got.collect()} == {0}


def test_signatures_of_linked_sets_meet():
    """The pigeonhole bound: sets at the threshold share a signature, whatever their sizes."""
    rng = np.random.default_rng(1)
    for percent in (50, 80, 85):
        classes = jaccard.Classes(percent)
        for _ in range(300):
            n = int(rng.integers(1, 120))
            pool = np.unique(rng.integers(1, 1 << 62, 400, dtype=np.int64)).astype(np.uint64)
            a = np.sort(pool[:n])
            drop, add = int(rng.integers(0, n)), int(rng.integers(0, 40))
            b = np.sort(np.concatenate([a[drop:], pool[n:n + add]]))
            if not len(b) or not jaccard.linked(a, b, percent) or np.array_equal(a, b):
                continue
            at = np.array([0, len(a), len(a) + len(b)])
            owner, sig, demand = classes.signatures(at, np.concatenate([a, b]))
            both = set(sig[owner == 0]) & set(sig[owner == 1])
            kind = classes.of(np.array([min(len(a), len(b))]))[0]
            need = {int(d & 0xFFFFFFFF) for o in (0, 1) for d in demand[owner == o] if d >> 32 == kind}
            mine = [x for x, d, o in zip(sig, demand, owner, strict=True) if o == 0 and d >> 32 == kind and x in both]
            assert len(mine) >= max(need)


def test_drop_near_keeps_one_of_each_group(spark):
    df = documents(spark, near_rows(), clash=True)
    kept = jaccard.drop_near(df)
    assert kept.columns == df.columns
    want = brute_components(near_rows(), 5, 80)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({c for _, _, c in want})
    messy = jaccard.drop_near(documents(spark, MESSY))
    assert Counter(r.doc_id for r in messy.collect()) == Counter([1, 4, 5, 6, 7, None, 9, 11, 12])


def test_drop_near_keeps_unrelated_texts_of_one_id(spark):
    """Components are told apart by their texts: an id that stands in two of them links nothing."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (7, b + " end", "en", "s", 1), (None, c, "en", "s", 1), (None, a + " end", "en", "s", 1)]
    got = Counter((r.doc_id, r.text) for r in jaccard.drop_near(documents(spark, rows)).collect())
    assert got == Counter([(5, a), (5, b), (None, c)])


# -------------------------------------------------------------- language ID

def brute_phrases(word, text):
    """Greedy cross-parse by substring search."""
    framed, at, n = f" {word} ", 0, 0
    while at < len(framed):
        length = 1
        while at + length < len(framed) and framed[at:at + length + 1] in text:
            length += 1
        at, n = at + length, n + 1
    return n


def test_cross_parse_equals_substring_search():
    samples = (("x", " the then theme them at hat "), ("y", " abba baobab aa b "))
    model = language.Model(samples)
    words = ["the", "hat", "theme", "zebra", "abab", "", "ththat", "é", "bab" * 9]
    got = model.phrases(words)
    assert got.tolist() == [[brute_phrases(w, t) for _, t in samples] for w in words]


def test_language_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.evaluate(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n >= 0.99


def test_language_of_one_word_does_not_win_other_texts(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(["the cat sat on the mat", "a dog ran to the house", "the men saw the sea"] * 5)]
    known = language.sample(documents(spark, [*rows, (99, "ok", "aa", "s", 1)]), "doc_id", "text", "lang")
    assert [n for n, _ in known] == ["aa", "en"]
    got = language.Model(known).predict(["the", "the cat ran to the sea", "that house on the hill", "ok", "ok ok"])[0]
    assert got == ["en", "en", "en", "aa", "aa"]


def test_language_sample_passes_over_words_that_do_not_fit(spark):
    rows = [(1, "x" * 70 + " one two", "en", "s", 1), (2, "x" * 70, "en", "s", 1), (3, "y" * 200, "zz", "s", 1), (4, "dix " + "z" * 30 + " six", "fr", "s", 1)]
    known = dict(language.sample(documents(spark, rows), "doc_id", "text", "lang", chars=40))
    assert set(known["en"].split()) == {"one", "two"} and known["zz"] == f" {'y' * 39} "
    assert sum(len(w) + 1 for w in known["fr"].split()) <= 40 and len(known["fr"].split()) == 3


def test_language_messy(spark):
    got = rows_of(language.evaluate(documents(spark, MESSY, clash=True)))
    assert len(got) == len(MESSY)
    by = {r[0]: r for r in got}
    assert all(by[i][2] == "und" and by[i][3] == 0 for i in (4, 5, 6, 12)) and all(0 <= r[3] <= 1 for r in got)
    assert {r[2] for r in got} <= {"und", "en", "de", "fr"}
    import zlib
    assert all(r[1] == (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in got)


def test_language_without_labels(spark):
    got = language.evaluate(documents(spark, [(1, "some words", None, "a", 1)]))
    assert [tuple(r)[2:] for r in got.collect()] == [("und", 0.0)]


def test_empty_tables(spark):
    df = documents(spark, [], clash=True)
    for got in (exact_dedup.mark_exact(df), exact_dedup.drop_exact(df), mixing.mix(df), mixing.mixed_rows(df), licenses.scan(df),
                pieces.encode(df), jaccard.join_components(df), jaccard.drop_near(df), language.evaluate(df)):
        assert got.collect() == []
