"""Line deduplication that returns run-length-compressed keep bitmaps (DataFrame functions only).

1. Lines become (document, position, 128-bit hash of the line's key), written once to the shared folder.
2. They are range-partitioned on (hash, document) and sorted by position within: a stream over the sorted rows
   meets the first occurrence of each key in each document. As the document is part of the range key, a line
   that a third of all documents hold is spread over as many partitions as it needs.
3. First occurrences are counted per key, combined before the shuffle: one row per key and task.
4. Lines of a counted-out key join back (Spark splits a hot key's partition) and become dropped runs
   [start, length) per document by a gaps-and-islands window: the compressed bitmap. No text takes part so far.
5. ``apply_bitmaps`` joins the bitmaps to the texts and keeps the other lines.

``mode="all"`` drops every line of a key found in ``min_docs`` documents or more, ``mode="rest"`` keeps the
first occurrence (smallest document id, then text hash, then position).

A document is a distinct (id, text): rows that repeat both count once and share the result. Null ids are a value
of their own. A null or empty text is one empty line, whose key is shorter than ``min_chars`` and never counts.
Other columns of the input are ignored by the bitmaps. An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm._common import ascii_lower, stage, two_hashes

SPACE = " \t\n\x0b\x0c\r"
MIN_DOCS, MIN_CHARS = 10, 1


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _doc_key(id_col: str, text_col: str):
    """(id, hash of the text); a null id gets a flag, so that joins need no null-safe comparison."""
    i, t = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    return [i.isNull().alias("no_id"), F.coalesce(i, F.lit(0)).alias("doc"), F.xxhash64(t).alias("text_hash")]


def line_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    mode: str = "all",
) -> DataFrame:
    """Documents that lose lines: no_id, doc, text_hash, n_dropped, drops (sorted array of (s, n) runs)."""
    if mode not in ("all", "rest"):
        raise ValueError("mode is 'all' or 'rest'")
    doc = ["no_id", "doc", "text_hash"]
    lines = (
        docs.select(*_doc_key(id_col, text_col), F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
        .select(*doc, "pos", ascii_lower(F.btrim("line", F.lit(SPACE))).alias("k"))
        .filter(F.char_length("k") >= min_chars)
        .select(*doc, "pos", *two_hashes(F.col("k"), "h1", "h2"))
    )
    lines = stage(lines, "line-hashes")
    by_key = Window.partitionBy("h1", "h2", *doc).orderBy("pos")
    firsts = (
        lines.repartitionByRange("h1", "h2", *doc)
        .withColumn("nth", F.row_number().over(by_key))
        .filter(F.col("nth") == 1)
    )
    counted = firsts.groupBy("h1", "h2").agg(
        F.count("*").alias("n_docs"), F.min(F.struct("no_id", "doc", "text_hash", "pos")).alias("first")
    )
    # written, so that Spark knows its size and can split a hot key of the other side
    frequent = stage(counted.filter(F.col("n_docs") >= min_docs), "frequent-lines")
    if mode == "all":
        dropped = lines.join(frequent.select("h1", "h2"), ["h1", "h2"])
    else:
        dropped = lines.join(frequent.select("h1", "h2", "first"), ["h1", "h2"]).filter(
            F.struct("no_id", "doc", "text_hash", "pos") != F.col("first")
        )
    in_doc = Window.partitionBy(*doc).orderBy("pos")
    runs = (
        dropped.select(*doc, "pos")
        .withColumn("run", F.col("pos") - F.dense_rank().over(in_doc))
        .groupBy(*doc, "run")
        .agg(F.min("pos").alias("s"), (F.max("pos") - F.min("pos") + 1).alias("n"))
    )
    return runs.groupBy(*doc).agg(
        F.sum("n").cast("bigint").alias("n_dropped"), F.array_sort(F.collect_list(F.struct("s", "n"))).alias("drops")
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a struct of the document's own columns), n_lines, n_dropped, kept (the text of the other lines)."""
    keyed = docs.select(F.struct("*").alias("row"), F.struct(*_doc_key(id_col, text_col)).alias("key"))
    marks = bitmaps.select(F.struct("no_id", "doc", "text_hash").alias("mark"), F.col("n_dropped").alias("n"), "drops")
    on = [F.col(f"key.{c}") == F.col(f"mark.{c}") for c in ("no_id", "doc", "text_hash")]
    text, d = F.coalesce(F.col("row")[text_col], F.lit("")), F.col("drops")

    def kept_lines(lines):
        # between the dropped runs: from the end of one to the start of the next
        def between(i):
            s = F.when(i == 0, F.lit(0)).otherwise(F.get(d, i - 1)["s"] + F.get(d, i - 1)["n"])
            e = F.coalesce(F.get(d, i)["s"], F.size(lines))
            return F.slice(lines, s + 1, e - s)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(d)), between))

    joined = keyed.join(marks, on, "left").withColumn("lines", _lines(text))
    return joined.select(
        "row",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(d.isNull(), text).otherwise(F.array_join(kept_lines(F.col("lines")), "\n")).alias("kept"),
    )
