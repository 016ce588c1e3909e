"""Corpus pipeline: the stages that documents go through before training.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` applies them to ``documents``, writing each
stage's rows as Parquet in the shared folder and reading them back. All but the last return the columns of
``documents``. Some steps can't be expressed in SQL (fitted trees, connected components, a tokenizer), so
``ORACLE_SQL`` is None; tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusflow.llm.decontaminate import decontaminate
from censusflow.llm.fitting import id_remainder
from censusflow.llm.line_dedup import dedup_lines
from censusflow.llm.ngram_join import jaccard_components
from censusflow.llm.packing import pack_documents
from censusflow.llm.tokenize import tokenizer_path
from censusflow.llm.toxicity import fit
from censusflow.llm.util import materialize, table

#: Near-duplicate documents: shingles of five words, Jaccard similarity of 0.8 or more.
SHINGLE, NUM, DEN = 5, 8, 10


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the model learns from labelled rows outside the held-out fold.

    A null text is scored as an empty one; null ids are no labelled rows; repeated rows get the same score and all stay or go;
    texts of any length are scored whole; an empty table gives no rows.
    """
    model = fit(docs, table(spark, sf_dir, "labels"), id_remainder(F.col("doc_id"), 5) != 0)
    scored = model.transform(docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text")), "_text", "_score")
    return scored.filter("_score < 0.5").select("_row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the near-duplicate lines that an earlier document (or line) has; n_chars follows.

    A document that loses lines and has no word left is a copy and goes; others stay, null and empty texts too. Repeated rows
    (equal id and text) keep the same lines; an empty table gives no rows.
    """
    out = dedup_lines(docs)
    out = out.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id, of its texts the one with the smallest hash.

    A row is known by its id and its text, so another text under a copy's id stays. Of rows with equal id and text one stays.
    Documents without words or without an id stay, each of them. An empty table gives no rows.
    """
    row = F.struct("doc_id", "text_key")
    groups = materialize(jaccard_components(docs, SHINGLE, NUM, DEN, row_keys=True).filter("group_key is not null").select("doc_id", "text_key", "group_key"), "near-groups")
    first = groups.groupBy("group_key").agg(F.min(row).alias("first"), F.count("*").alias("n")).filter("n > 1")
    rows = groups.join(first, "group_key").groupBy("doc_id", "text_key").agg(F.max(row != F.col("first")).alias("copy"), F.count("*").alias("n"))
    rows = materialize(rows.filter("copy or n > 1").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "copy"), "near-copies")
    same = (F.xxhash64(docs["text"]) == rows["_key"]) & (docs["doc_id"] == rows["_id"])
    kept = docs.join(rows, same, "left_anti")
    # equal rows: only those that stay are shuffled by what makes them equal
    equal = docs.join(rows.filter("not copy"), same, "left_semi").withColumn("_key", F.xxhash64("text")).dropDuplicates(["doc_id", "_key"])
    return kept.select(*docs.columns).unionByName(equal.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark's windows.

    A row is known by its id and its text. Null and empty texts hold no window and stay; repeated rows stay or go together; an
    empty table gives no rows.
    """
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    gone = materialize(found.filter("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "contaminated")
    same = (F.xxhash64(docs["text"]) == gone["_key"]) & docs["doc_id"].eqNullSafe(gone["_id"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a training sequence; null texts count as empty, repeated rows are packed each."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", packed),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
