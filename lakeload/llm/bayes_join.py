"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; two are linked when the sets' Jaccard similarity is 0.8 or more.

1. One scan makes, per document, a 128-bit key of its word sequence and the hashes of 40 bands of five MinHash
   values. Documents with one key are a class (exact copies of the words); only one row per class goes on.
2. Classes that share a band bucket are candidates. A pair at 0.8 shares none with probability 1e-7. Buckets
   with the same members count once.
3. Pruning: within a bucket, MinHash values are compared a few at a time; after each step a pair is dropped when
   the posterior probability (uniform prior) that its similarity reaches the threshold is below ``tolerance``.
   Surviving pairs are not emitted, only a spanning forest of them; its connected components bound the true links.
4. Verification: the classes of a component are compared pair by pair, again pruned step by step, and the rest
   exactly on the shingles. A class gets its numbers of links, and the forest of the exact links.
5. The exact links' components are the groups.

Large buckets and components are dealt in blocks of ``block`` classes, one task per pair of blocks, so no group
meets whole in one task and nothing is capped; tasks emit at most one row per class, never the pairs. Texts are
read again only for candidates.

Nulls and edge cases: a null or empty text has no words; all such documents are one class without links to others.
Under five words the whole text is one shingle. A document is a distinct (id, text), and repeated rows give
one result row each and count as copies. Null ids are never a class's id unless all are null. Other columns are
ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm._common import stage, words
from lakeload.llm.components import connected

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS = 40, 5
BLOCK, STEP = 1024, 25

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32)
_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """r^0..r^(n-1) and the inverses' powers, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, r in enumerate((_R, pow(_R, -1, 1 << 64))):
            p = np.full(2 * n, r, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(line: bytes, n: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of every n words of a line of words with one space between, sorted."""
    if not line:
        return np.empty(0, np.uint64)
    b = np.frombuffer(line, np.uint8)
    space = np.flatnonzero(b == 32)
    starts, ends = np.append(0, space + 1), np.append(space, len(b))
    if len(starts) > n:
        starts, ends = starts[: len(starts) - n + 1], ends[n - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    power, inverse = _power(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[: len(b)], out=sums[1:])
    return np.unique(_mix((sums[ends] - sums[starts]) * inverse[starts]))


def minhash(s: np.ndarray) -> np.ndarray:
    """BANDS * ROWS MinHash values (32 bits)."""
    low, out = (s >> np.uint64(32)).astype(np.uint32), np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 512):
        np.minimum(out, ((low[k : k + 512] ^ _B[:, None]) * _A[:, None]).min(axis=1), out=out)
    return out


def least_matches(threshold: float, tolerance: float, steps: list[int]) -> list[int]:
    """For each number n of compared values the fewest matches m that leave P(J >= threshold | m of n) >= tolerance.

    With a uniform prior the posterior is Beta(m+1, n-m+1), and P(J >= t) = P(Binomial(n+1, t) <= m).
    """
    out = []
    for n in steps:
        p, m = 0.0, -1
        while p < tolerance:
            m += 1
            p += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _line(text: str | None) -> bytes:
    return b" ".join(words(text))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, text) -> (doc_id, text_hash, key, bands)."""
    for b in batches:
        keys, bands = [], []
        for text in b.column(2).to_pylist():
            line = _line(text)
            keys.append(hashlib.blake2b(line, digest_size=16).digest())
            s = shingles(line)
            v = minhash(s).reshape(BANDS, ROWS).astype(np.uint64)
            h = np.arange(1, BANDS + 1, dtype=np.uint64)
            for k in range(ROWS):
                h = _mix(h * np.uint64(_R) + v[:, k] + np.uint64(1))
            bands.append(h.view(np.int64).tolist() if len(s) else [])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "text_hash", "key", "bands"],
        )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) -> (key, sig: 16 bits of each MinHash value, shingles)."""
    for b in batches:
        if b.num_rows:
            s = [shingles(_line(t)) for t in b.column(1).to_pylist()]
            sig = [minhash(x).astype(np.uint16).tobytes() for x in s]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sig, pa.binary()), pa.array([x.tobytes() for x in s], pa.binary())],
                names=["key", "sig", "shingles"],
            )


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[tuple]]:
    """Runs of rows with equal first ``by`` columns; rows come sorted by them."""
    group: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if group and row[:by] != group[0][:by]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _survivors(sig: np.ndarray, left: np.ndarray, right: np.ndarray, steps: list[int], least: list[int]):
    """Pairs (i of left, j of right, i before j) that no step drops; compared in slices of rows."""
    for k in range(0, len(left), 64):
        i, j = np.meshgrid(left[k : k + 64], right, indexing="ij")
        ok = i < j
        i, j = i[ok], j[ok]
        matches, done = np.zeros(len(i), np.int16), 0
        for n, m in zip(steps, least):
            matches += (sig[i, done:n] == sig[j, done:n]).sum(axis=1, dtype=np.int16)
            keep = matches >= m
            i, j, matches, done = i[keep], j[keep], matches[keep], n
            if not len(i):
                break
        if len(i):
            yield i, j


class _Forest:
    """Union-find over the rows of a task; roots are the smallest row."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:  # drop pairs already joined, join the first of the others for every i, again
            while (self.up[self.up] != self.up).any():
                self.up = self.up[self.up]
            a, b = self.up[i], self.up[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            np.minimum.at(self.up, hi, lo)


def _blocks(group: list[tuple], at: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers to compare with one another; the column ``at`` holds a row's own block, at - 1 and at - 2 the pair."""
    bi, bj = group[0][at - 2], group[0][at - 1]
    own = np.array([r[at] for r in group])
    return np.flatnonzero(own == bi), np.flatnonzero(own == bj)


def _prune(steps: list[int], least: list[int]):
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(group, bi, bj, own, key, sig) -> forest edges (a, b) of the pairs that survive."""
        a: list[bytes] = []
        b: list[bytes] = []
        for g in _groups(batches, 3):
            g.sort(key=lambda r: r[3])  # rows of the first block before those of the second
            sig = np.stack([np.frombuffer(r[5], np.uint16) for r in g])
            forest = _Forest(len(g))
            for i, j in _survivors(sig, *_blocks(g, 3), steps, least):
                forest.link(i, j)
            for x in range(len(g)):
                r = forest.root(x)
                if r != x:
                    a.append(g[x][4])
                    b.append(g[r][4])
            if len(a) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return prune


def _verify(steps: list[int], least: list[int], threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(group, bi, bj, own, key, n_docs, sig, shingles) -> (key, classes, docs, root) for each linked row."""
        rows: list[tuple] = []
        for g in _groups(batches, 3):
            g.sort(key=lambda r: r[3])
            sig = np.stack([np.frombuffer(r[6], np.uint16) for r in g])
            sets = [np.frombuffer(r[7], np.uint64) for r in g]
            sizes, weight = np.array([len(s) for s in sets]), np.array([r[5] for r in g])
            ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
            cut = np.append(0, np.cumsum(sizes))
            seen = np.zeros(ids.max() + 1, bool)
            forest, classes, docs = _Forest(len(g)), np.zeros(len(g), np.int64), np.zeros(len(g), np.int64)
            for i, j in _survivors(sig, *_blocks(g, 3), steps, least):
                # |A & B| / |A | B| >= t needs sizes within t of one another
                ok = np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j])
                i, j = i[ok], j[ok]
                for x in np.unique(i):
                    js = j[i == x]
                    mine = ids[cut[x] : cut[x + 1]]
                    seen[mine] = True
                    for p in range(0, len(js), 256):
                        part = js[p : p + 256]
                        flat = np.concatenate([ids[cut[y] : cut[y + 1]] for y in part])
                        heads = np.append(0, np.cumsum(sizes[part]))[:-1]
                        both = np.add.reduceat(seen[flat], heads, dtype=np.int64)
                        linked = part[both >= threshold * (sizes[x] + sizes[part] - both) - 1e-9]
                        if len(linked):
                            classes[x] += len(linked)
                            docs[x] += weight[linked].sum()
                            classes[linked] += 1
                            docs[linked] += weight[x]
                            forest.link(np.full(len(linked), x), linked)
                    seen[mine] = False
            for x in np.flatnonzero(classes):
                rows.append((g[x][4], int(classes[x]), int(docs[x]), g[forest.root(int(x))][4]))
            if len(rows) > 20_000:
                yield _linked(rows)
                rows = []
        yield _linked(rows)

    def _linked(rows):
        c = list(zip(*rows)) if rows else [()] * 4
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds)], names=["key", "classes", "docs", "root"])

    return verify


def _pairs_of_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Deal rows (grp, n, key, ...) to the tasks (grp, bi, bj) of all pairs of the group's blocks."""
    n = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("key"), n).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    rest = [c for c in rows.columns if c not in ("grp", "n", "own", "other", "key")]
    rows = rows.select("grp", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "key", *rest)
    return rows.repartition("grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj")


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    block: int = BLOCK,
) -> DataFrame:
    """Per document row: doc_id, text_hash, class_id, copy_id, n_copies, n_link_classes, n_links.

    copy_id is the smallest id with the same words, n_copies the number of such rows; class_id the smallest id of
    the group that links connect; n_links counts the other documents linked (copies too), n_link_classes those
    with different words, copies counting once.
    """
    steps = list(range(STEP, BANDS * ROWS + 1, STEP))
    least = least_matches(threshold, tolerance, steps)
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    rows = stage(texts.mapInArrow(_describe, f"doc_id {id_type}, text_hash long, key binary, bands array<long>"), "join-bands")
    # nulls come last, so that a class is known by a real id if it has one
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    classes = stage(rows.groupBy("key").agg(first, F.count("*").alias("n_docs"), F.first("bands").alias("bands")), "join-classes")

    # buckets with two members or more, those with the same members once
    member = classes.select("key", F.explode("bands").alias("grp"))
    bits = [F.bit_xor(F.xxhash64(*seed, "key")).alias(x) for x, seed in (("x", []), ("y", [F.lit(7)]))]
    buckets = member.groupBy("grp").agg(F.count("*").alias("n"), *bits).filter(F.col("n") > 1)
    buckets = stage(buckets.groupBy("n", "x", "y").agg(F.min("grp").alias("grp")).select("grp", "n"), "join-buckets")
    member = stage(member.join(buckets, "grp"), "join-members")

    candidates = member.select("key").distinct().join(classes.select("key", "first", "n_docs"), "key")
    of_first = [F.col("c.first")[c].eqNullSafe(F.col(f"t.{c}")) for c in ("doc_id", "text_hash")]
    chosen = texts.alias("t").join(candidates.alias("c"), of_first[0] & of_first[1]).select("c.key", "t.text")
    features = stage(
        chosen.dropDuplicates(["key"]).mapInArrow(_features, "key binary, sig binary, shingles binary"), "join-features"
    )

    pruning = _pairs_of_blocks(member.join(features.select("key", "sig"), "key"), block)
    forest = stage(pruning.mapInArrow(_prune(steps, least), "a binary, b binary"), "join-pruned")
    component = connected(forest)  # node, root
    sized = component.join(component.groupBy("root").agg(F.count("*").alias("n")), "root")
    sized = sized.select(F.col("root").alias("grp"), "n", F.col("node").alias("key"))
    dealt = _pairs_of_blocks(
        sized.join(classes.select("key", "n_docs"), "key").join(features, "key").select("grp", "n", "key", "n_docs", "sig", "shingles"),
        block,
    )
    links = dealt.mapInArrow(_verify(steps, least, threshold), "key binary, classes long, docs long, root binary")
    links = stage(links, "join-links")

    # blocks of one component see parts of it: join the parts
    group = connected(links.select(F.col("key").alias("a"), F.col("root").alias("b")).filter("a != b"))
    linked = links.groupBy("key").agg(F.sum("classes").alias("n_link_classes"), F.sum("docs").alias("others"))
    known = classes.select("key", "first", "n_docs").join(group.withColumnRenamed("node", "key"), "key", "left")
    known = known.withColumn("root", F.coalesce("root", "key"))
    smallest = known.groupBy("root").agg(F.min("first").alias("smallest"))
    known = (
        known.join(smallest, "root")
        .join(linked, "key", "left")
        .select(
            "key",
            F.col("smallest.doc_id").alias("class_id"),
            F.col("first.doc_id").alias("copy_id"),
            F.col("n_docs").alias("n_copies"),
            F.coalesce("n_link_classes", F.lit(0)).cast("bigint").alias("n_link_classes"),
            (F.col("n_docs") - 1 + F.coalesce("others", F.lit(0))).cast("bigint").alias("n_links"),
            F.col("smallest.text_hash").alias("class_hash"),
        )
    )
    return rows.select("doc_id", "text_hash", "key").join(known, "key").drop("key")


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
c AS (SELECT array_to_string(ws, ' ') AS k, any_value(ws) AS ws, min(doc_id) AS copy_id, count(*) AS n_copies FROM d GROUP BY 1),
s AS (SELECT DISTINCT copy_id, array_to_string(ws[i+1:i+5], ' ') AS g
  FROM (SELECT copy_id, ws, unnest(range(greatest(1, len(ws) - 4))) AS i FROM c WHERE len(ws) > 0)),
z AS (SELECT copy_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT x.copy_id AS a, y.copy_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.copy_id <> y.copy_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN z x ON x.copy_id = a JOIN z y ON y.copy_id = b WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
r(node, reach) AS (SELECT copy_id, copy_id FROM c UNION SELECT node, b FROM r JOIN e ON e.a = reach),
g AS (SELECT node, min(reach) AS class_id FROM r GROUP BY 1),
l AS (SELECT a, count(*) AS n_link_classes, sum(n_copies) AS others FROM e JOIN c ON c.copy_id = b GROUP BY 1)
SELECT d.doc_id, class_id, c.copy_id, n_copies::BIGINT AS n_copies, coalesce(n_link_classes, 0)::BIGINT AS n_link_classes,
  (n_copies - 1 + coalesce(others, 0))::BIGINT AS n_links
FROM d JOIN c ON c.k = array_to_string(d.ws, ' ') JOIN g ON g.node = c.copy_id LEFT JOIN l ON l.a = c.copy_id"""
