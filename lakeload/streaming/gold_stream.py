"""Incremental gold loads with Structured Streaming.

The silver table is a file source (one ``LoadDate=`` partition per load). A stream over it with
``trigger(availableNow=True)`` picks up the loads written since the last run (tracked in the stream's
checkpoint, in the shared checkpoint folder) and merges each of them, oldest first, through
``foreachBatch`` into the gold dimension: the same create/merge as the batch load, driven by newly
arrived data instead of a listing. Gold records the last load it holds, in the same commit as the rows;
loads at or before it are passed over, so a retried micro-batch, a re-written old day or a new
checkpoint merges nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeload.plans.layout import Layout
from lakeload.plans.roles import LOAD_DATE_COL
from lakeload.plans.runs import IGNORE, merge_into_gold
from lakeload.sources.store import last_load


def _merge_batch(spark: SparkSession, layout: Layout, table_name: str, options: dict, audit: list) -> Callable:
    def run(batch: DataFrame, batch_id: int) -> None:
        # load stamps of this micro-batch: one per silver load, a handful of strings
        loads = sorted(r[0] for r in batch.select(LOAD_DATE_COL).distinct().collect())
        last = last_load(spark, layout.gold(table_name))
        for load in loads:
            if last and load <= last:
                continue
            rows = batch.filter(F.col(LOAD_DATE_COL) == F.lit(load))
            audit.append(merge_into_gold(spark, layout, table_name, rows, load, load=load, **options))

    return run


def gold_stream(
    spark: SparkSession,
    layout: Layout,
    table_name: str,
    checkpoint: str,
    on_same_hash: str = IGNORE,
    close_missing: bool = False,
    audit: list | None = None,
) -> StreamingQuery:
    """Start the stream (available-now trigger); the caller waits with ``awaitTermination()``.

    Every new file goes into one micro-batch (no per-trigger file cap): a load is merged whole, never
    in pieces. Start it after the silver load has been committed."""
    silver = layout.silver(table_name)
    schema = spark.read.parquet(silver).withColumn(LOAD_DATE_COL, F.col(LOAD_DATE_COL).cast("string")).schema
    stream = spark.readStream.schema(schema).format("parquet").load(silver)
    options = {"on_same_hash": on_same_hash, "close_missing": close_missing}
    sink = audit if audit is not None else []
    return (
        stream.writeStream.foreachBatch(_merge_batch(spark, layout, table_name, options, sink))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
