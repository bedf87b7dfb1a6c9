"""The pipeline against a brute-force version of its stages, and its contract."""

import hashlib
import importlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from warehaus.llm import language, mixing, pieces
from warehaus.llm.common import stored
from test_documents import MESSY, brute_components, brute_phrases, brute_targets, documents

SMALL = "/root/testdata/sf0.001"


def brute_mix(rows):
    """(doc_id -> words taken) with one shard, by single seats and a walk along the seeded order."""
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in rows}
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r["doc_id"])
    total = {s: sum(size[i] for i in ids) for s, ids in by.items()}
    goal = {s: round(t, 6) for s, t in brute_targets(total).items()}
    taken = {}
    for s, ids in by.items():
        words = int(goal[s] + 0.5)  # one shard: its blocks and the settled words are the whole target
        ids = sorted(ids, key=lambda i: (hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest(), i))
        taken.update(dict.fromkeys(ids, 0))
        while words > 0 and total[s]:
            for i in ids:
                step = min(words, size[i])
                taken[i] += step
                words -= step
    return size, taken


def brute_pieces(model, text):
    """Best-scoring segmentation by trying every piece at every place."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    score = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    unknown = min(s for s, _ in score.values()) - 10
    byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
    words = ("▁" + text.replace(" ", "▁"))
    longest = max(map(len, score))
    best = [(0.0, None)] + [(float("-inf"), None)] * len(words)
    for at in range(len(words)):
        for n in range(1, min(longest, len(words) - at) + 1):
            if words[at:at + n] in score:
                s = best[at][0] + score[words[at:at + n]][0]
                if s > best[at + n][0]:
                    best[at + n] = (s, (at, [score[words[at:at + n]][1]]))
        if words[at] not in score and best[at][0] + unknown > best[at + 1][0]:
            best[at + 1] = (best[at][0] + unknown, (at, [byte[b] for b in words[at].encode()]))
    ids, at = [], len(words)
    while at:
        at, step = best[at][1]
        ids = step + ids
    return ids


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's rows over the small documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SMALL), "test-pipeline"))
    return out


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_stage_order_and_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights",
                     "SentencePiece encoding and decoding"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_language_stage_drops_only_texts_without_letters(stages):
    want = Counter(r["doc_id"] for r in dicts(stages[0]) if any(c.isalpha() for c in r["text"] or ""))
    assert Counter(r["doc_id"] for r in dicts(stages[1])) == want


def test_language_stage_fills_labels(spark):
    """A missing label is the one with the fewest phrases by substring search; a given one stays, even a wrong one."""
    some = [r for r in dicts(spark.read.parquet(f"{SMALL}/documents.parquet")) if r["lang"] and 0 < len(r["text"] or "") < 3000][:60]
    hidden = {r["doc_id"] for r in some[::4]}
    rows = [(r["doc_id"], r["text"], None if r["doc_id"] in hidden else r["lang"], "s", 1) for r in some]
    rows += [(-1, some[1]["text"], "xx", "s", 1), (-2, "12 !", None, "s", 1)]
    docs = documents(spark, rows)
    known = language.sample(docs, "doc_id", "text", "lang")
    want = {}
    for i, text, lang, *_ in rows:
        words = language.LETTERS.findall(text.lower())
        if words:
            want[i] = lang or min(known, key=lambda k: (sum(brute_phrases(w, k[1]) for w in words), k[0]))[0]
    got = {r["doc_id"]: r["lang"] for r in dicts(corpus_pipeline.language_id(spark, docs, SMALL))}
    assert got == want and got[-1] == "xx" and len(hidden & set(got)) > 5


def test_language_stage_keeps_rows_when_nothing_is_labelled(spark):
    rows = [(1, "some words", None, "a", 1), (2, "12 !", None, "a", 1), (3, None, "en", "a", 1), (4, "中文", None, "a", 1)]
    got = dicts(corpus_pipeline.language_id(spark, documents(spark, rows), SMALL))
    assert {r["doc_id"]: r["lang"] for r in got} == {1: "und", 4: "und"}


def test_exact_stage(stages):
    last = {}
    for r in dicts(stages[1]):
        last[r["text"]] = max(last.get(r["text"], r["doc_id"]), r["doc_id"])
    assert {r["text"]: r["doc_id"] for r in dicts(stages[2])} == last


def test_near_stage(stages):
    rows = [(r["doc_id"], r["text"], "", "", 0) for r in dicts(stages[2])]
    want = {c for _, _, c in brute_components(rows, 5, 80)}
    assert sorted(r["doc_id"] for r in dicts(stages[3])) == sorted(want)


def test_mixing_stage(stages):
    rows = dicts(stages[3])
    size, taken = brute_mix(rows)
    want = Counter({i: int(taken[i] / size[i] + 0.5) for i in size if size[i]})
    assert Counter(r["doc_id"] for r in dicts(stages[4])) == +want


def test_token_stage(stages):
    model = pieces._model_bytes(pieces.DEFAULT_MODEL)
    got = dicts(stages[5])
    assert len(got) == stages[4].count() and all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in got)
    texts = {r["doc_id"]: r["text"] for r in dicts(stages[4])}
    short = sorted(got, key=lambda r: r["n_ids"])[:40]
    assert all(r["ids"] == brute_pieces(model, texts[r["doc_id"]]) for r in short)


def test_run_equals_the_stages(spark, stages):
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in dicts(corpus_pipeline.run(spark, SMALL)))
    assert got == Counter((r["doc_id"], tuple(r["ids"])) for r in dicts(stages[5]))


def test_stages_take_messy_and_empty_tables(spark):
    clashing = {"keep_id", "key", "size", "ids", "lang_pred", "score", "whole", "place"}
    for rows in (MESSY, []):
        docs = documents(spark, rows, clash=True)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SMALL), "test-messy")
            assert clashing <= set(docs.columns)
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert all(r["round_trip"] for r in dicts(last)) and (last.count() > 0) == bool(rows)


def test_registered_queries():
    import __spark_entry__ as entry
    importlib.reload(entry)
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {x[:x.index("_") + 1] for x in names if x.startswith("op")} and "pipeline" in names
    assert {x for x in entry.oracle_sql() if x.startswith("op")} == {"op1_warc", "op3_license_scan", "op4_exact_dedup", "op6_ngram_jaccard", "op10_mixing",
                                                                       "op11_merkle", "op12_prefix_trie"}
