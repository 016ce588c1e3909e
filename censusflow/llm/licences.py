"""Licence scan with a positional rare-token index, in DataFrame functions only.

A template is a licence label with its mandatory key phrases. Inverse document frequencies of the licence
words come from all texts. The index holds, for each phrase, the positions of its ``anchors`` highest-IDF
words. A file's anchor words are looked up in it; every posting proposes the place where its phrase would
begin, and a place stays if all anchors propose the same one. There the whole phrase is verified.

Only files that hold all words of some phrase keep the positions of their licence words, so what is moved
is the licence words of possible files, never texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Phrase:
    label: str
    text: str
    base: bool = False


PHRASES: tuple[Phrase, ...] = (
    Phrase("mit", "under the mit license", True),
    Phrase("apache-2", "apache license version 2", True),
    Phrase("cc-by-nc", "cc by nc", True),
    Phrase("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Phrase("apache-2", "licensed under the apache license"),
    Phrase("cc-by-nc", "creative commons attribution noncommercial"),
    Phrase("cc-by-sa", "cc by sa"),
    Phrase("cc-by-sa", "creative commons attribution sharealike"),
    Phrase("cc0", "cc0 1 0 universal"),
    Phrase("gpl", "gnu general public license"),
    Phrase("lgpl", "gnu lesser general public license"),
    Phrase("agpl", "gnu affero general public license"),
    Phrase("bsd", "redistribution and use in source and binary forms"),
    Phrase("mpl", "mozilla public license"),
    Phrase("epl", "eclipse public license"),
    Phrase("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Phrase("unlicense", "this is free and unencumbered software released into the public domain"),
    Phrase("all-rights-reserved", "all rights reserved"),
)


def ascii_lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def scan(docs: DataFrame, phrases: Sequence[Phrase] = PHRASES, anchors: int = 2) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` grows with the IDF of the anchors of the distinct phrases found, from 0 (none) towards 1.
    A null or empty text has no words and no label; overlapping places all count; repeated rows each get a
    row; other columns, whatever their names, are not read. Very long texts are read whole; an empty table gives no rows.
    """
    spark = docs.sparkSession
    split = [p.text.split() for p in phrases]
    lexicon = sorted({w for ws in split for w in ws})
    lex = F.array(*map(F.lit, lexicon))
    seen = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.split(ascii_lower(F.col("text")), DELIMITERS).alias("w"))
    # a delimiter at an end of the text leaves an empty first or last string
    lead, tail = (F.element_at("w", 1) == "").cast("int"), ((F.element_at("w", -1) == "") & (F.size("w") > 1)).cast("int")
    seen = seen.select("uid", "doc_id", "w", lead.alias("lead"), (F.size("w") - lead - tail).cast("long").alias("n_words"),
                       F.array_intersect("w", lex).alias("present"))
    whole = [F.size(F.array_except(F.array(*map(F.lit, sorted(set(ws)))), "present")) == 0 for ws in split]
    possible = whole[0]
    for w in whole[1:]:
        possible = possible | w
    hits = F.filter(F.transform("w", lambda x, i: F.struct((i - F.col("lead")).cast("long").alias("pos"), x.alias("word"))), lambda h: h["word"].isin(lexicon))
    seen = materialize(seen.select("uid", "doc_id", "n_words", "present", F.when(possible, hits).alias("hits")), "licence-words")

    # at most one row per licence word
    df = seen.select(F.explode("present").alias("word")).groupBy("word").count()
    n = seen.count()
    idf = df.select("word", F.log(F.lit(n + 1) / F.col("count")).alias("idf"))
    postings = spark.createDataFrame([(k, i, w) for k, ws in enumerate(split) for i, w in enumerate(ws)], "phrase int, off int, word string")
    info = spark.createDataFrame([(k, p.label, p.base, len(ws)) for k, (p, ws) in enumerate(zip(phrases, split))], "phrase int, label string, base boolean, size int")
    # as many rows as the templates have words
    index = (postings.join(F.broadcast(idf), "word", "left").withColumn("idf", F.coalesce("idf", F.lit(0.0)))
             .withColumn("rank", F.row_number().over(Window.partitionBy("phrase").orderBy(F.desc("idf"), "off")))
             .withColumn("anchor", F.col("rank") <= anchors).drop("rank"))
    index = materialize(index.coalesce(1), "licence-index")

    places = seen.filter("hits is not null").select("uid", F.explode("hits").alias("h")).select("uid", "h.pos", "h.word")
    rare = places.join(F.broadcast(index.filter("anchor").select("phrase", "off", "word")), "word")
    size = F.broadcast(info)
    proposed = (rare.groupBy("uid", "phrase", (F.col("pos") - F.col("off")).alias("at")).count()
                .join(size, "phrase").filter(F.col("count") == F.least("size", F.lit(anchors))).select("uid", "phrase", "at"))
    # every word of the phrase has to stand at its place
    wanted = proposed.join(F.broadcast(index.select("phrase", "off", "word")), "phrase").select("uid", "phrase", "at", (F.col("at") + F.col("off")).alias("pos"), "word")
    found = (wanted.join(places, ["uid", "pos", "word"]).groupBy("uid", "phrase", "at").count()
             .join(size, "phrase").filter(F.col("count") == F.col("size")))
    weight = index.filter("anchor").groupBy("phrase").agg(F.sum("idf").alias("idf"))
    per_phrase = (found.groupBy("uid", "phrase", "label", "base").agg(F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"))
                  .join(F.broadcast(weight), "phrase"))
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = lambda c: F.when(F.col("base"), F.col(c))
    per_doc = per_phrase.groupBy("uid").agg(
        F.sum(base("n")).alias("n_base"), F.min(base("lo")).alias("first_word"), F.max(base("hi")).alias("last_word"),
        labels(base("label")).alias("base_labels"), labels("label").alias("labels"), F.sum("idf").alias("evidence"))
    return seen.select("uid", "doc_id", "n_words").join(per_doc, "uid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.round(F.coalesce(F.col("evidence") / (1 + F.col("evidence")), F.lit(0.0)), 6).alias("score"))


def duckdb_sql(phrases: Sequence[Phrase] = PHRASES, anchors: int = 2) -> str:
    """The same result in DuckDB SQL: every place is tested for every phrase."""
    rows = ", ".join(f"({k}, '{p.label}', {str(p.base).lower()}, {p.text.split()})" for k, p in enumerate(phrases))
    return rf"""
WITH p(phrase, label, base, ws) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS uid, doc_id,
             list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
      FROM documents),
df AS (SELECT word, count(*) AS c FROM (SELECT unnest(list_distinct(w)) AS word FROM d) GROUP BY word),
idx AS (SELECT phrase, off, x.word, coalesce(ln(((SELECT count(*) FROM d) + 1) / c), 0.0) AS idf
        FROM (SELECT phrase, unnest(ws) AS word, generate_subscripts(ws, 1) AS off FROM p) x LEFT JOIN df USING (word)),
wt AS (SELECT phrase, sum(idf) AS idf FROM (SELECT *, row_number() OVER (PARTITION BY phrase ORDER BY idf DESC, off) AS r FROM idx) WHERE r <= {anchors} GROUP BY phrase),
f AS (SELECT uid, phrase, label, base, pos FROM (
        SELECT uid, w, phrase, label, base, ws, unnest(range(len(w))) AS pos FROM d, p WHERE list_has_all(w, ws))
      WHERE w[pos + 1] = ws[1] AND w[pos + 1 : pos + len(ws)] = ws),
g AS (SELECT uid, phrase, label, base, count(*) AS n, min(pos) AS lo, max(pos) AS hi FROM f GROUP BY ALL),
r AS (SELECT uid, sum(n) FILTER (base) AS n_base, min(lo) FILTER (base) AS first_word, max(hi) FILTER (base) AS last_word,
             array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
             array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, sum(wt.idf) AS e
      FROM g JOIN wt USING (phrase) GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(e / (1 + e), 0.0), 6) AS score
FROM d LEFT JOIN r USING (uid)"""
