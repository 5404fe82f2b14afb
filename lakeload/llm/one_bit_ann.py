"""Nearest neighbours by cosine with randomly rotated one-bit codes.

A unit vector is rotated into ``bits`` dimensions by a random matrix with orthonormal columns and kept as its signs
and one correction scalar f = <signs / sqrt(bits), rotated vector>. For a rotated query, quantised to four bits a
dimension, the inner product with the signs (and so <vector, query> / f) comes from AND and population counts of
packed words. Its error is below err = eps * sqrt((1 - f^2) / f^2 / (bits - 1)) with very high probability, so
only vectors with estimate + err at or above the query's k-th best exact score so far are compared exactly.

Queries (a stated set) go against all rows in blocks: at most ``block`` queries are broadcast at a time, and each
block is one scan, written before the next block's queries are read. Tasks hold one tile of codes and k results per
query, and send k rows per query; ranks are taken per query over those, ties by the smaller id. No row is dropped or capped.

Vectors that are null, empty, all zero, of another dimension than the block's queries, or hold null or non-finite
components take no part, nor do rows with a null id. Rows that share an id are candidates each; as queries
the first by value stands for the id. A query is not its own candidate (by id). Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm._common import stage
from lakeload.session import scratch_path

BITS, EPS, TILE, PLANES = 256, 3.0, 4096, 4
BLOCK = 20_000
K = 5


def rotation(dim: int, bits: int, seed: int = 11) -> np.ndarray:
    """dim x bits, rows orthonormal (bits >= dim)."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).T.copy()


class Codes:
    """One-bit codes of unit vectors."""

    def __init__(self, unit: np.ndarray, turn: np.ndarray):
        x = unit @ turn
        bits = x.shape[1]
        self.words = np.packbits(x > 0, axis=1).view(np.uint64)  # vectors x words
        self.ones = np.bitwise_count(self.words).sum(axis=1).astype(np.float64)
        self.factor = np.abs(x).sum(axis=1) / np.sqrt(bits)
        f2 = np.minimum(self.factor**2, 1.0)
        self.err = EPS * np.sqrt((1 - f2) / f2 / max(1, bits - 1))


class Queries:
    """Rotated queries, quantised to PLANES bits a dimension and cut into bit planes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bits: int):
        self.ids, self.vectors, self.norms = ids, vectors, np.linalg.norm(vectors, axis=1)
        bits = -(-max(bits, vectors.shape[1]) // 64) * 64
        self.turn = rotation(vectors.shape[1], bits)
        x = (vectors / self.norms[:, None]) @ self.turn
        top = (1 << PLANES) - 1
        self.low = x.min(axis=1)
        self.step = np.maximum((x.max(axis=1) - self.low) / top, 1e-12)
        level = np.rint((x - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.total = x.sum(axis=1)
        self.planes = [np.packbits((level >> p) & 1, axis=1).view(np.uint64) for p in range(PLANES)]
        self.root = np.sqrt(bits)
        # rounding moves a coordinate by half a step at most; the roundings of random signs add up like a walk
        self.rounding = EPS * self.step / 2

    def estimate(self, rows: slice, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines of some queries with all codes, and their error bounds."""
        acc = np.zeros((len(self.ids[rows]), len(codes.ones)), np.int32)
        for p, plane in enumerate(self.planes):
            for w in range(plane.shape[1]):
                acc += np.bitwise_count(plane[rows, w, None] & codes.words[None, :, w]).astype(np.int32) << p
        at_ones = self.low[rows, None] * codes.ones + self.step[rows, None] * acc
        est = (2 * at_ones - self.total[rows, None]) / self.root / codes.factor
        return est, codes.err + self.rounding[rows, None] / codes.factor


class Best:
    """The k best (score, id) of every query so far."""

    def __init__(self, n: int, k: int):
        self.score, self.id = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def take(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        s, i = np.append(self.score[q], score), np.append(self.id[q], ids)
        order = np.lexsort((i, -s))[:k]
        self.score[q], self.id[q] = s[order], i[order]


def search(queries: Queries, best: Best, ids: np.ndarray, vectors: np.ndarray) -> None:
    """Take one tile of (ids, vectors in double precision) into the best results so far."""
    k, norms = best.score.shape[1], np.linalg.norm(vectors, axis=1)
    codes = Codes(vectors / norms[:, None], queries.turn)
    for p in range(0, len(queries.ids), 32):
        rows = slice(p, min(p + 32, len(queries.ids)))
        est, err = queries.estimate(rows, codes)
        for r in range(rows.start, rows.stop):
            left = ids != queries.ids[r]

            def exact(at: np.ndarray, r: int = r) -> None:
                best.take(r, vectors[at] @ queries.vectors[r] / (norms[at] * queries.norms[r]), ids[at])

            e = est[r - p]
            if best.score[r, -1] == -np.inf and left.sum() > 4 * k:  # a first bound from the best estimates
                top = np.argpartition(np.where(left, -e, np.inf), 2 * k)[: 2 * k]
                exact(top)
                left[top] = False
            exact(np.flatnonzero(left & (e + err[r - p] >= best.score[r, -1])))


def _usable(c: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    some = F.exists(c, lambda x: x != 0)
    return c.isNotNull() & (F.size(c) > 0) & F.forall(c, fine) & some


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    bits: int = BITS,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k nearest; ``is_query`` picks the queries."""
    rows = vectors.withColumn("_q", is_query).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), "_q"
    )
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("v")))
    spark = vectors.sparkSession
    asked = stage(rows.filter("_q").groupBy("id").agg(F.min("v").alias("v")), "ann-queries")
    n = asked.count()
    blocks = max(1, -(-n // block))
    schema, path = "query_id long, vec_id long, score double", scratch_path(spark, "ann-found")
    spark.createDataFrame([], schema).write.parquet(path)
    for b in range(blocks if n else 0):  # a block's result is written and its broadcast gone before the next
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        by_dim: dict[int, list] = {}
        for r in sorted(part):
            by_dim.setdefault(len(r.v), []).append(r)
        sets = {d: Queries(np.array([r.id for r in x]), np.array([r.v for r in x]), bits) for d, x in by_dim.items()}
        shared = spark.sparkContext.broadcast(sets)
        rows.select("id", "v").mapInArrow(_search(shared, k), schema).write.mode("append").parquet(path)
        shared.destroy()
    found = spark.read.schema(schema).parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = shared.value
        state = {d: Best(len(q.ids), k) for d, q in sets.items()}
        waiting: dict[int, list] = {d: [] for d in sets}

        def flush(d: int) -> None:
            if waiting[d]:
                ids, vs = (np.concatenate(x) for x in zip(*waiting[d]))
                waiting[d] = []
                search(sets[d], state[d], ids, vs)

        for b in batches:
            offsets = b.column(1).offsets.to_numpy()
            values = b.column(1).values.to_numpy(zero_copy_only=False)
            ids, size = b.column(0).to_numpy(), np.diff(offsets)
            for d in sets:
                at = np.flatnonzero(size == d)
                if len(at):
                    waiting[d].append((ids[at], values[offsets[at][:, None] + np.arange(d)]))
                    if sum(len(x[0]) for x in waiting[d]) >= TILE:
                        flush(d)
        for d, q in sets.items():
            flush(d)
            best = state[d]
            keep = np.isfinite(best.score)
            qs = np.broadcast_to(q.ids[:, None], keep.shape)[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(qs), pa.array(best.id[keep]), pa.array(best.score[keep])], names=["query_id", "vec_id", "score"]
            )

    return run
