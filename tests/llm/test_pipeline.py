"""Every stage against a brute-force version of itself on the stage's own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from lakeload.llm._common import words
from lakeload.llm.decontaminate import item_windows
from tests.llm.test_bayes_join import brute as near
from tests.llm.test_line_dedup import key

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, step in cp.STAGES:
        path = str(tmp_path_factory.mktemp("p") / name)
        step(spark, docs, SF).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(steps):
    for before, after in steps[:-1]:
        assert after.dtypes == before.dtypes


def test_quality(spark, steps):
    before, after = map(rows, steps[0])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    known = [i for i in before if i in labels]
    assert all(after[i] == before[i] for i in after)
    assert sum((i in after) == (labels[i] == 1) for i in known) >= 0.97 * len(known)


def test_lines(steps):
    before, after = map(rows, steps[1])
    seen = {}
    for r in before.values():
        for k in {key(x) for x in r.text.split("\n")} - {""}:
            seen[k] = seen.get(k, 0) + 1
    want = {i: "\n".join(x for x in r.text.split("\n") if seen.get(key(x), 0) < 10) for i, r in before.items()}
    assert {i: r.text for i, r in after.items()} == want and any(want[i] != before[i].text for i in want)
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_near_duplicates(steps):
    before, after = map(rows, steps[2])
    classes = {r[0]: r[1] for r in near([(i, r.text) for i, r in before.items()])}
    assert set(after) == set(classes.values()) and len(after) < len(before)
    assert all(after[i] == before[i] for i in after)


def test_benchmark(spark, steps):
    before, after = map(rows, steps[3])
    windows = item_windows([tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()], 13)
    for i, r in before.items():
        w, hit = words(r.text), set()
        for p in windows:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
        assert (i in after) == (not hit or 20 * len(hit) < len(w))
    assert all(after[i] == before[i] for i in after)


def test_packing(steps):
    before, after = steps[4]
    assert {r[0] for r in before.select("doc_id").collect()} == {r[0] for r in after.select("doc_id").collect()}
    got = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d"))
    assert got.filter("n <> d").count() == 0


def test_repeated_and_null_rows(spark, tmp_path):
    d = tmp_path / "sf"
    base = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (9_001, "", "en", "s", 0), (9_002, None, "en", "s", None)], base.schema)
    base.union(base.filter("doc_id < 5")).union(extra).write.parquet(f"{d}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    got = cp.run(spark, str(d)).collect()
    assert got and len({(r.doc_id, r.start) for r in got}) == len(got)


def test_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_other_columns_and_long_texts_pass_through(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = " ".join(r.text for r in docs.filter("doc_id < 60").collect())
    docs = docs.union(spark.createDataFrame([(9_001, long, "en", "s", len(long))], docs.schema))
    names = ["row", "key", "kept", "n_dropped", "n_lines", "pos", "spans", "items", "h1", "h2", "i", "h", "text_hash", "class_id", "score", "ids"]
    wide = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, step in cp.STAGES[:-1]:
        path = str(tmp_path / name)
        step(spark, wide, SF).write.parquet(path)
        wide = spark.read.parquet(path)
        got = wide.collect()
        assert wide.columns == [*docs.columns, *names] and len(got) > 50
        assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)
    packed = cp.packing(spark, wide, SF)
    assert packed.agg(F.sum("length")).first()[0] == packed.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
