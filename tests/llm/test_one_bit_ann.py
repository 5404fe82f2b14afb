import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeload.llm import one_bit_ann as ann


def brute(rows, is_query, k=5):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = []
    for q in sorted({i for i, _ in ok if is_query(i)}):
        x = min((v.tolist() for i, v in ok if i == q))
        s = [(-(v @ x) / (np.linalg.norm(v) * np.linalg.norm(x)), i) for i, v in ok if i != q and len(v) == len(x)]
        out += [(q, r + 1, i, -c) for r, (c, i) in enumerate(sorted((round(c, 12), i) for c, i in s)[:k])]
    return out


def run(spark, rows, mod=5, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).repartition(3)
    got = ann.nearest(df, F.col("vec_id") % mod == 0, **kw).orderBy("query_id", "rank").collect()
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in got]


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-10)


@pytest.mark.parametrize("dim", [2, 8, 70])
@pytest.mark.parametrize("block", [20_000, 4])
def test_equals_brute_force(spark, dim, block, monkeypatch):
    monkeypatch.setattr(ann, "TILE", 50)
    x = np.random.default_rng(dim).normal(size=(150, dim))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    same(run(spark, rows, mod=10, block=block), brute(rows, lambda i: i % 10 == 0))


def test_unusable_vectors_ties_and_repeats(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [5.0, 0.0]), (3, [0.0, 1.0]), (4, [-1.0, 0.5]), (5, [0.0, 0.0]), (6, None),
            (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0]), (10, [1.0, 1.0]),
            (11, [3.0, 0.0]), (15, []), (20, [1.0, 2.0, 3.0]), (3, [0.0, 1.0]), (0, [1.0, 0.0])]
    same(run(spark, rows), brute(rows, lambda i: i % 5 == 0))


def test_fewer_candidates_than_ranks_and_empty(spark):
    assert [g[:3] for g in run(spark, [(0, [1.0]), (1, [2.0]), (2, [-1.0])])] == [(0, 1, 1), (0, 2, 2)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, [(1, [1.0])]) == [] and run(spark, []) == []


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0).collect()
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = {w[:3:2] for w in brute(rows, lambda i: i % 50 == 0)}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.99 * len(want) and len(got) == len(want)


def test_bounds_hold_and_prune():
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(2000, 64))
    q = ann.Queries(np.arange(20), x[:20], 256)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    est, err = q.estimate(slice(0, 20), ann.Codes(unit, q.turn))
    off = np.abs(est - unit[:20] @ unit.T)
    assert (off <= err).mean() > 0.999 and np.sqrt((off**2).mean()) < 0.06 and err.mean() < 0.25
