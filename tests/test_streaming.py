"""The available-now gold stream gives the same dimension as the batch loads."""

import os

from lakeload.plans.layout import Layout
from lakeload.plans.runs import load_gold
from lakeload.sources.files import append_silver
from lakeload.sources.store import read_table
from lakeload.streaming.gold_stream import gold_stream
from lakeload.operators.prepare import hash_key

DAYS = {
    "2024-03-09": [(1, "a"), (2, "b")],
    "2024-03-10": [(1, "a"), (2, "B"), (3, "c")],
}


def _load(spark, layout, day, rows, table):
    df = hash_key(spark.createDataFrame(rows, "KEY_k int, v string"))
    from pyspark.sql import functions as F

    append_silver(df.withColumn("LoadDate", F.lit(day)), layout.silver(table))


def _rows(df):
    return sorted((r["KEY_k"], r["v"], r["SK_t"], r["created_date"], r["updated_date"]) for r in df.collect())


def test_stream_equals_batch(spark, tmp_base):
    batch, stream = Layout(os.path.join(tmp_base, "b")), Layout(os.path.join(tmp_base, "s"))
    ckpt = os.path.join(tmp_base, "ckpt")
    audit = []
    for day, rows in DAYS.items():
        _load(spark, batch, day, rows, "DIM2_t")
        load_gold(spark, batch, "DIM2_t", day)
        _load(spark, stream, day, rows, "DIM2_t")
        gold_stream(spark, stream, "DIM2_t", checkpoint=ckpt, audit=audit).awaitTermination()
    assert [a["status"] for a in audit] == ["created", "merged"]
    assert _rows(read_table(spark, stream.gold("DIM2_t"))) == _rows(read_table(spark, batch.gold("DIM2_t")))
    # nothing new: the stream does nothing
    gold_stream(spark, stream, "DIM2_t", checkpoint=ckpt, audit=audit).awaitTermination()
    assert len(audit) == 2


def test_stream_catches_up_in_load_order(spark, tmp_base):
    batch, stream = Layout(os.path.join(tmp_base, "b2")), Layout(os.path.join(tmp_base, "s2"))
    for day, rows in DAYS.items():
        _load(spark, batch, day, rows, "DIM2_t")
        load_gold(spark, batch, "DIM2_t", day)
        _load(spark, stream, day, rows, "DIM2_t")
    audit = []
    gold_stream(spark, stream, "DIM2_t", checkpoint=os.path.join(tmp_base, "ck2"), audit=audit).awaitTermination()
    assert [(a["run_date"], a["status"]) for a in audit] == [("2024-03-09", "created"), ("2024-03-10", "merged")]
    assert _rows(read_table(spark, stream.gold("DIM2_t"))) == _rows(read_table(spark, batch.gold("DIM2_t")))

