"""Corpus pipeline over ``documents``: one training-data operator per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``; the last returns the packed pieces.
Each stage works on all rows that its predecessor kept.

Null ids and texts pass through as the operators define them. Repeated rows are one group of copies for the
near-duplicate stage, so one of them stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm._common import stage, table
from lakeload.llm.bayes_join import jaccard_join
from lakeload.llm.decontaminate import contaminated, decontaminate
from lakeload.llm.line_crf import fit_field, keep_good
from lakeload.llm.line_dedup import apply_bitmaps, line_bitmaps
from lakeload.llm.packing import pack_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field rejects (score under 0.7) go."""
    return keep_good(docs, fit_field(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go from every document; the documents stay, n_chars follows."""
    kept = apply_bitmaps(docs, line_bitmaps(docs))
    new = {
        "text": F.when(F.col("n_dropped") == 0, F.col("row.text")).otherwise(F.col("kept")),
        "n_chars": F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.char_length("kept").cast("bigint")),
    }
    return kept.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of 0.8 or more connect, the document with the smallest id stays."""
    groups = jaccard_join(docs)
    keep = stage(groups.select(F.col("class_id").alias("i"), F.col("class_hash").alias("h")).distinct(), "kept-documents")
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    rows = keyed.join(keep, F.col("row.doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")))
    return rows.dropDuplicates(["i", "h"]).select("row.*")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go if a twentieth of their words or more lie in benchmark windows."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col="row")
    return found.filter(~contaminated()).select("doc_id.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("packing", packing),
]
ORACLE_SQL = None  # the quality and packing stages are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
