"""Ranks and running totals inside groups of any size, over globally sorted rows.

A window partitioned by the group would give a group to one task. Here the rows are range-partitioned by (group,
order), so that a large group spans many partitions:

1. sort within partitions; every task numbers and sums the rows of each group as far as it sees them and writes them;
2. the first and last row of every partition (two rows a partition, whatever the input) tell what the group that is cut
   by a partition's start has gathered before; these carries are broadcast;
3. rows of cut groups add their carry.

Totals are modulo 2^64. A digest column v has, besides a running total, the polynomial ``sum(v * base**k)`` over the k-th rows
of its group, which depends on the rows' order; it composes over a cut as ``carry + base**rank * own``.

Group columns are non-null longs. Rows that tie in ``order`` come in any order; the caller makes ties interchangeable.
A group of a single row, repeated rows and an empty frame need nothing special.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.llm._common import stage

BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, for the digest columns in turn
_M64 = (1 << 64) - 1


def _longs(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class _Powers:
    """base**k and base**-k modulo 2^64 for k below the longest batch."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = (
                np.cumprod(np.append(np.uint64(1), np.full(n - 1, b, np.uint64)), dtype=np.uint64) for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


def _local(group: list[str], sums: list[str], digests: list[str]):
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        powers = [_Powers(BASES[k]) for k in range(len(digests))]
        key, rank = None, 0  # of the last row so far
        total, poly = [0] * len(sums), [0] * len(digests)
        waiting = None  # the last batch: whether its last row ends a group is not known yet

        def closed(cols: list, names: list[str], last: np.ndarray, edge: bool) -> pa.RecordBatch:
            edges = np.zeros(len(last), bool)
            edges[-1] = edge
            return pa.RecordBatch.from_arrays([*cols, pa.array(last), pa.array(edges)], names=[*names, "_last", "_edge"])

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = np.stack([_longs(b, g) for g in group])
            change = np.ones(n, bool)
            change[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            head = np.zeros(n, bool)
            if key is None:
                head[0] = True
            else:
                change[0] = bool((keys[:, 0] != key).any())
            if waiting is not None:
                waiting[2][-1] = change[0]
                yield closed(*waiting, edge=False)
            begins = change.copy()
            begins[0] = True
            start = np.flatnonzero(begins)[np.cumsum(begins) - 1]
            goes_on = (start == 0) & ~change[0]  # rows of the group that the batch before ended with
            at = np.arange(n)
            ranks = at - start + 1 + np.where(goes_on, rank, 0)
            cols, names = list(b.columns), list(b.schema.names)
            for k, c in enumerate(sums):
                s = np.append(np.uint64(0), np.cumsum(_longs(b, c), dtype=np.uint64))
                run = s[at + 1] - s[start] + np.where(goes_on, np.uint64(total[k]), np.uint64(0))
                total[k] = int(run[-1])
                cols.append(_signed(run))
                names.append(f"{c}_run")
            for k, c in enumerate(digests):
                up, down = powers[k].upto(n)
                s = np.append(np.uint64(0), np.cumsum(_longs(b, c) * up, dtype=np.uint64))
                shift = np.where(goes_on, np.uint64(pow(BASES[k], rank, 1 << 64)), np.uint64(1)) * down[start]
                carry = np.where(goes_on, np.uint64(poly[k]), np.uint64(0))
                own, before = ((s[i] - s[start]) * shift + carry for i in (at + 1, at))
                poly[k] = int(own[-1])
                cols += [_signed(own), _signed(before)]
                names += [f"{c}_poly", f"{c}_before"]
            key, rank = keys[:, -1].copy(), int(ranks[-1])
            last = np.append(change[1:], True)
            cols += [pa.array(ranks), pa.array(np.full(n, pid, np.int32)), pa.array(head)]
            waiting = (cols, [*names, "rank", "_pid", "_head"], last)
        if waiting is not None:
            yield closed(*waiting, edge=True)

    return local


def _carries(ends: list, group: list[str], sums: list[str], digests: list[str]) -> tuple[dict, set]:
    """From the partitions' first and last rows: pid -> (group, rank, totals, polynomials) before it; pids that end in mid-group."""
    by_pid: dict[int, dict] = {}
    for r in ends:
        for kind in ("_head", "_edge"):
            if r[kind]:
                by_pid.setdefault(r["_pid"], {})[kind] = r
    carry, open_ends, state, before = {}, set(), None, None
    for pid in sorted(by_pid):
        head, edge = by_pid[pid]["_head"], by_pid[pid]["_edge"]
        first, final = (tuple(r[g] for g in group) for r in (head, edge))
        rank, run, poly = edge["rank"], [edge[f"{c}_run"] for c in sums], [edge[f"{c}_poly"] for c in digests]
        if state is not None and state[0] == first:
            carry[pid] = state
            open_ends.add(before)
            if first == final:
                shift = [pow(b, state[1], 1 << 64) for b in BASES]
                rank += state[1]
                run = [(x + y) & _M64 for x, y in zip(run, state[2])]
                poly = [(y + s * x) & _M64 for x, y, s in zip(poly, state[3], shift)]
        state, before = (final, rank, [x & _M64 for x in run], [x & _M64 for x in poly]), pid
    return carry, open_ends


def _carried(shared, group: list[str], sums: list[str], digests: list[str]):
    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, open_ends = shared.value
        for b in batches:
            pid = b.column("_pid").to_numpy()
            cut = [(p, carry[p]) for p in np.unique(pid).tolist() if p in carry]
            rows = [(pid == p) & np.all([b.column(g).to_numpy() == v for g, v in zip(group, c[0])], axis=0) for p, c in cut]
            new = {"rank": b.column("rank").to_numpy().copy()}
            new |= {f"{c}_run": _longs(b, f"{c}_run").copy() for c in sums}
            new |= {f"{c}_{x}": _longs(b, f"{c}_{x}").copy() for c in digests for x in ("poly", "before")}
            for at, (_, (_, rank, run, poly)) in zip(rows, cut):
                new["rank"][at] += rank
                for c, x in zip(sums, run):
                    new[f"{c}_run"][at] += np.uint64(x)
                for c, x, base in zip(digests, poly, BASES):
                    for name in (f"{c}_poly", f"{c}_before"):
                        new[name][at] = np.uint64(x) + np.uint64(pow(base, rank, 1 << 64)) * new[name][at]
            edge = b.column("_edge").to_numpy(zero_copy_only=False)
            last = b.column("_last").to_numpy(zero_copy_only=False) & ~(edge & np.isin(pid, list(open_ends)))
            kept = [c for c in b.schema.names if c not in ("_pid", "_head", "_edge", "_last")]
            cols = [_signed(new[c]) if c in new else b.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(last)], names=[*kept, "last"])

    return carried


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str] = (),
    digests: Sequence[str] = (),
    label: str = "running",
) -> DataFrame:
    """Adds rank (from 1) and last; ``<c>_run`` for each of ``sums``; ``<c>_poly`` and, without the row itself, ``<c>_before``
    for each of ``digests`` (two at most). Sums and digests are non-null longs."""
    group, sums, digests = list(group), list(sums), list(digests)
    spark = df.sparkSession
    long = lambda names: [T.StructField(c, T.LongType()) for c in names]
    added = [f"{c}_run" for c in sums] + [f"{c}_{x}" for c in digests for x in ("poly", "before")] + ["rank"]
    flags = [T.StructField(c, T.BooleanType()) for c in ("_head", "_last", "_edge")]
    schema = T.StructType([*df.schema.fields, *long(added), T.StructField("_pid", T.IntegerType()), *flags])
    keys = [*map(F.col, group), *(F.col(c).asc_nulls_first() for c in order)]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    seen = stage(ranged.mapInArrow(_local(group, sums, digests), schema), label)
    ends = seen.filter("_head or _edge").select(*group, *added, "_pid", "_head", "_edge").collect()  # two rows a partition
    shared = spark.sparkContext.broadcast(_carries(ends, group, sums, digests))
    out = T.StructType([*df.schema.fields, *long(added), T.StructField("last", T.BooleanType())])
    return seen.mapInArrow(_carried(shared, group, sums, digests), out)
