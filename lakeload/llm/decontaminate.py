"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the benchmark items' windows of 13 consecutive words (an item of fewer words is one window).
Symbols are words. For each pattern length a shift table on blocks of two words says how far the scan may jump,
blocks with shift 0 select a bucket of patterns ending in that block, and a direct comparison confirms an
occurrence. The scan therefore looks at about one word in twelve of ordinary text.

The patterns are (window, item) pairs, cut out of the items in tasks and dealt by hash into as many blocks as keep each
near ``max_block_windows`` pairs, so a long item, many copies of one, or a window that many items share is spread over
blocks. One block of patterns at a time is read by the driver and broadcast; it is a scan of the documents, and its
hits (places and items, no texts) are written before the next block is read. One block is the usual case: the
documents then stream through once and are never shuffled. Beyond it, hits of a text are merged by id and text hash.

Nulls and edge cases: a null or empty text has no words and is clean; an item without words is no pattern; items
sharing an id count once, a null item id counts as an item with an empty id; repeated rows and null document ids
give one result row each; other columns are ignored; empty tables give empty results (all clean). Texts and items of
any length are taken whole. Occurrences may overlap; a word counts once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.llm._common import stage, two_hashes, words
from lakeload.session import scratch_path

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
MAX_BLOCK_WINDOWS = 500_000


class WuManber:
    """Search for many word sequences at once; ``search`` yields (start, end, items) of each occurrence."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[str]]):
        self.vocab: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list[str]]] = {}
        for w, items in windows.items():
            ids = tuple(self.vocab.setdefault(x, len(self.vocab)) for x in w)
            by_length.setdefault(len(w), {})[ids] = items
        self.tables = []
        for m, patterns in by_length.items():
            b = min(2, m)
            shift: dict[tuple[int, ...], int] = {}
            bucket: dict[tuple[int, ...], dict[tuple[int, ...], list[str]]] = {}
            for p, items in patterns.items():
                for end in range(b, m + 1):
                    block = p[end - b : end]
                    shift[block] = min(shift.get(block, m), m - end)
                bucket.setdefault(p[m - b :], {})[p] = items
            self.tables.append((m, b, shift, bucket))

    def search(self, text: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        get, n = self.vocab.get, len(text)
        for m, b, shift, bucket in self.tables:
            at, jump = m, m - b + 1  # the window under the scan ends before `at`
            while at <= n:
                last = get(text[at - 1])
                if last is None:  # in no pattern: no window that holds this word can match
                    at += m
                    continue
                block = (last,) if b == 1 else (get(text[at - 2]), last)
                s = shift.get(block, jump)
                if s:
                    at += s
                    continue
                found = bucket[block].get(tuple(map(get, text[at - m : at])))
                if found is not None:
                    yield at - m, at, found
                at += 1


def item_windows(items: list[tuple[object, str | None]], size: int) -> dict[tuple[bytes, ...], list[str]]:
    out: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            out.setdefault(tuple(w[k : k + size]), set()).add("" if item is None else str(item))
    return {w: sorted(i) for w, i in out.items()}


_SPANS = T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))
_SPANS_ARROW = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _windows(size: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(item, text) -> (window, item): words joined by spaces, once for each item."""
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1)):
                w = words(text.as_py())
                found = {b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1) if w else 0)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sorted(found), pa.binary()), pa.array([item] * len(found), pa.string())], names=["window", "item"]
                )

    return windows


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places without overlaps, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_block_windows: int = MAX_BLOCK_WINDOWS,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, spans (hit word ranges), items (ids, sorted)."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    pairs = stage(items.mapInArrow(_windows(window), "window binary, item string").distinct(), "decontaminate-windows")
    blocks = max(1, -(-pairs.count() // max_block_windows))
    id_type = docs.schema[id_col].dataType
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hits = [T.StructField("spans", _SPANS), T.StructField("items", T.ArrayType(T.StringType()))]
    longs = [T.StructField(c, T.LongType()) for c in ("n_words", "n_hit", "n_items")]
    result = T.StructType([T.StructField("doc_id", id_type), *longs, T.StructField("items_sha256", T.StringType()), *hits])

    def patterns(k: int):
        found: dict[tuple[bytes, ...], list[str]] = {}
        part = pairs.filter(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == k)
        for r in part.toLocalIterator():  # about max_block_windows rows
            found.setdefault(tuple(bytes(r.window).split()), []).append(r.item)
        return spark.sparkContext.broadcast(WuManber(found))

    if blocks == 1:
        return frame.mapInArrow(_scan(patterns(0), True), result)

    keyed = frame.select("doc_id", "text", *two_hashes(F.coalesce("text", F.lit("")), "h1", "h2"))
    some = T.StructType([T.StructField("doc_id", id_type), *(T.StructField(c, T.LongType()) for c in ("h1", "h2")), *hits])
    path = scratch_path(spark, "decontaminate-hits")
    for k in range(blocks):
        shared = patterns(k)
        met = keyed.select("doc_id", "text", "h1", "h2").mapInArrow(_scan(shared, False), some)
        # copies of a row have the same hits
        met.dropDuplicates(["doc_id", "h1", "h2"]).write.mode("append").parquet(path)
        shared.destroy()
    found = spark.read.schema(some).parquet(path).groupBy("doc_id", "h1", "h2").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    found = found.select(F.col("doc_id").alias("i"), F.col("h1").alias("i1"), F.col("h2").alias("i2"), "spans", "items")
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("h1") == F.col("i1")) & (F.col("h2") == F.col("i2"))
    whole = keyed.join(found, same, "left").select("doc_id", "text", "spans", "items")
    return whole.mapInArrow(_finished, result)


def _results(ids: pa.Array, n_words: list[int], spans: list[list[tuple[int, int]]], items: list[list[str]]) -> pa.RecordBatch:
    hit = [sum(e - s for s, e in x) for x in spans]
    sha = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
    longs = [pa.array(x, pa.int64()) for x in (n_words, hit, [len(i) for i in items])]
    places = pa.array([[{"s": s, "e": e} for s, e in x] for x in spans], _SPANS_ARROW)
    return pa.RecordBatch.from_arrays(
        [ids, *longs, pa.array(sha, pa.string()), places, pa.array(items, pa.list_(pa.string()))],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "spans", "items"],
    )


def _scan(shared, whole: bool):
    """Search documents for a block of patterns: the result rows, or (``whole`` false) the hits of documents with any."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.search
        for b in batches:
            if not b.num_rows:
                continue
            spans, items, n_words, at = [], [], [], []
            for r, text in enumerate(b.column(1).to_pylist()):
                w = words(text)
                hits, ids = [], set()
                for s, e, found in find(w):
                    hits.append((s, e))
                    ids.update(found)
                if whole or hits:
                    n_words.append(len(w))
                    spans.append(merged_spans(hits))
                    items.append(sorted(ids))
                    at.append(r)
            if whole:
                yield _results(b.column(0), n_words, spans, items)
                continue
            places = pa.array([[{"s": s, "e": e} for s, e in x] for x in spans], _SPANS_ARROW)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(rows) for c in (0, 2, 3)), places, pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "h1", "h2", "spans", "items"],
            )

    return scan


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans, items) of all blocks -> the result rows."""
    for b in batches:
        spans = [merged_spans([(x["s"], x["e"]) for x in s or ()]) for s in b.column(2).to_pylist()]
        items = [sorted(set(i or ())) for i in b.column(3).to_pylist()]
        yield _results(b.column(0), [len(words(t)) for t in b.column(1).to_pylist()], spans, items)


def contaminated():
    """At least a twentieth of the document's words lie in benchmark windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
