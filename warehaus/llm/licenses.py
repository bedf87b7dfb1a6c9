"""Licence notices found by a positional index of rare words.

Every template (a notice as a sequence of words) is indexed by word and
position.  Document frequencies of the template words are counted over all
texts.  For each template its highest-IDF words are the seeds: a template of n
words that may miss m of them has m + 1 seeds, so every placement close enough
contains one of them at its place.  In a text, each seed occurrence is looked
up; its postings (template, position) give the start at which the template
would lie.  The words at the same relative positions are intersected, and a
placement counts when enough of them agree and the template's mandatory key
phrase stands verbatim in it.

Everything is one projection over the text's word array, plus one small
aggregate (at most one row per template word) for the frequencies, which is
collected: its size is bounded by the templates.

Defined results: null and blank texts have no words and no labels; a null id
is kept; a very long text is one word array in its task's memory; placements of
several templates at one place all count, and of equal scores the highest is
the score whichever template has it; repeated rows give equal rows; other
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warehaus.llm.common import lower_ascii

# The phrases that must be found verbatim, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Customary wordings of licence notices (label, words, key phrase).
NOTICES = (
    ("apache", "licensed under the apache license", "apache license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "source and binary forms"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd", "cc by nd"),
    ("cc0", "dedicated to the public domain under cc0", "cc0"),
    ("gpl", "this work is licensed under the gnu general public license", "gnu general public license"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
)
AGREEMENT = 0.8  # least share of a notice's words at their places
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array; the ends of the split are empty strings, which go."""
    cut = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(cut, lambda w: w != "")


def templates(agreement: float = AGREEMENT) -> list[dict]:
    out = [{"label": lab, "words": ph.split(), "key": ph.split(), "need": len(ph.split()), "base": True}
           for ph, lab in BASE]
    for lab, notice, key in NOTICES:
        w = notice.split()
        out.append({"label": lab, "words": w, "key": key.split(), "need": max(1, math.ceil(agreement * len(w))),
                    "base": False})
    for t in out:
        t["at"] = next(i for i in range(len(t["words"])) if t["words"][i:i + len(t["key"])] == t["key"])
    return out


def seeds(found: list[dict], frequency: dict[str, int]) -> list[dict]:
    """Postings of each template's rarest words: (word, position, template number)."""
    posts = []
    for n, t in enumerate(found):
        rare = sorted(range(len(t["words"])), key=lambda i: (frequency.get(t["words"][i], 0), t["words"][i], i))
        for i in rare[:len(t["words"]) - t["need"] + 1]:
            posts.append({"word": t["words"][i], "place": i, "template": n})
    return posts


def frequencies(texts: DataFrame, vocabulary: list[str], text_col: str) -> dict[str, int]:
    """In how many texts each vocabulary word stands, over all texts."""
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    seen = texts.select(F.explode(F.array_intersect(words_of(texts[text_col]), vocab)).alias("word"))
    return {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", agreement: float = AGREEMENT) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and ``placements`` (start, label, agreeing words, length).

    ``score`` is the largest share of a template's words found at their places
    among the counted placements, 0 without any.
    """
    found = templates(agreement)
    posts = seeds(found, frequencies(df, sorted({w for t in found for w in t["words"]}), text_col))
    by_word: dict[str, list[dict]] = {}
    for p in posts:
        by_word.setdefault(p["word"], []).append(p)
    index = F.create_map(*[x for w, ps in by_word.items() for x in (
        F.lit(w), F.array(*[F.struct(F.lit(p["place"]).alias("place"), F.lit(p["template"]).alias("template"))
                            for p in ps]))])
    plan = F.array(*[F.struct(
        F.array(*map(F.lit, t["words"])).alias("words"), F.array(*map(F.lit, t["key"])).alias("key"),
        F.lit(t["at"]).alias("at"), F.lit(t["need"]).alias("need"), F.lit(t["label"]).alias("label"),
        F.lit(t["base"]).alias("base")) for t in found])
    keys = F.array(*[F.lit(w) for w in by_word])
    base = df.select(df[id_col].alias("doc_id"), words_of(df[text_col]).alias("words"))
    # Few texts hold a seed word; the others skip the positional work.
    base = base.withColumn("any", F.arrays_overlap("words", keys))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                    lambda x: F.array_contains(keys, x["w"]))
    starts = F.array_distinct(F.flatten(F.transform("hits", lambda x: F.transform(
        F.element_at(F.col("index"), x["w"]),
        lambda p: F.struct((x["i"] - p["place"]).alias("start"), p["template"].alias("template"))))))

    def placed(c: Column) -> Column:
        t = F.element_at(F.col("plan"), c["template"] + 1)
        agree = F.aggregate(F.sequence(F.lit(0), F.size(t["words"]) - 1), F.lit(0), lambda n, j: n + F.when(
            F.get("words", c["start"] + j) == F.element_at(t["words"], j + 1), 1).otherwise(0))
        key = F.forall(F.sequence(F.lit(0), F.size(t["key"]) - 1), lambda j: F.coalesce(
            F.get("words", c["start"] + t["at"] + j) == F.element_at(t["key"], j + 1), F.lit(False)))
        return F.struct(c["start"].cast("long").alias("start"), t["label"].alias("label"), t["base"].alias("base"),
                        agree.alias("agree"), F.size(t["words"]).alias("length"), (key & (agree >= t["need"])).alias("ok"))

    one = base.withColumns({"index": index, "plan": plan}) \
        .withColumn("hits", F.when(F.col("any"), hits)) \
        .withColumn("starts", F.coalesce(starts, F.array().cast("array<struct<start:int,template:int>>"))) \
        .withColumn("placements", F.filter(F.transform("starts", placed), lambda x: x["ok"])) \
        .withColumn("n_words", F.size("words").cast("long"))
    base_at = F.array_distinct(F.transform(F.filter("placements", lambda x: x["base"]),
                                           lambda x: F.struct(x["start"].alias("start"), x["label"].alias("label"))))
    joined = lambda col: F.array_join(F.array_sort(F.array_distinct(col)), ",")
    out = one.withColumn("base_at", base_at)
    first = F.transform("base_at", lambda x: x["start"])
    return out.select(
        "doc_id", "n_words", F.size("base_at").cast("long").alias("n_base"), F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"), joined(F.transform("base_at", lambda x: x["label"])).alias("base_labels"),
        joined(F.transform("placements", lambda x: x["label"])).alias("labels"),
        F.coalesce(F.array_max(F.transform("placements", lambda x: x["agree"] / x["length"])), F.lit(0.0)).alias("score"),
        "placements")
