"""Prefix trie of conversations, screened by a count-min sketch of prefix digests.

A node of depth d is a distinct sequence of the first d turns of a conversation. Each turn has a 128-bit hash of its role
and text; the digest of a prefix is a polynomial of its turns' hashes (``running``), so it needs no row that holds a
conversation, and a conversation with a third of all turns is spread over tasks like many short ones.

1. Screening. Every prefix of every conversation adds one to its cells of a count-min sketch: tasks send bit planes
   (met, met again) of the cells they touched, the planes are merged block by block. An estimate never falls below the
   true count, so estimate one proves that a prefix has one conversation. Such nodes have one member, one leaf below, nothing
   to save and a child until the conversation ends: they are emitted where they stand.
   The sketch has four cells a prefix and row, ``MAX_CELLS`` a row at most (then it is 25 MB, whatever the input).
   Beyond that more prefixes are taken for possibly shared; results do not change.
2. Exact grouping. Only possibly shared prefixes are shuffled, to be grouped by digest and depth with map-side
   combining: members, smallest member, ends. Children are counted by their parents' digest.
3. Subtrees. What a node saves, and a childless node, are booked to the node's smallest member at the node's depth. A
   running total from the end of each conversation towards its start gives each of its prefixes what was booked below it;
   summed over a node's members that is the total of its subtree, as each node is booked once.
4. A child finds its parent's smallest member behind the parent in rows sorted by the parent's digest. That too is a
   running total: a parent with a third of all nodes as children is no hot key of a join.
5. The members that end at a node are sorted over all tasks and joined into texts of at most ``CHUNK_IDS`` ids. The hash of
   such a list needs its texts one after the other, so they stream through the node's task, which keeps the hash's state only.

Rebuilding (``rebuilt_turns``): a conversation takes the first turns of its base conversation instead of as many own.

Nulls and edge cases: turns are ordered by turn, null first, ties by a hash of role and text, so ties and repeated rows
have a defined order; a null role or text is empty; rows with a null conv_id belong to no conversation; a conversation
without turns is a member of the root; other columns are ignored; an empty table has no nodes. Long texts count whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm._common import stage
from lakeload.llm.running import running

ROWS, CELLS_A_PREFIX, MIN_CELLS, MAX_CELLS = 3, 4, 1 << 12, 1 << 26
BLOCKS = 64  # blocks that a row of the sketch is merged in
FLUSH = 1 << 20  # prefixes a task gathers before it sends planes
CHUNK_IDS = 1 << 16


def turns_of(conversations: DataFrame) -> DataFrame:
    """(c, turn, a, b, len): the turns with 128 hash bits of role and text, and the text's code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(0x5851F42D), text, role).alias("b"), F.char_length(text).cast("long").alias("len"),
    )


def head_turns(c: Column, of: int = 6) -> Column:
    """How many turns a conversation takes from its base."""
    return F.crc32(c.cast("string")) % of


def rebuilt_turns(turns: DataFrame, convs: DataFrame, every: int = 100, of: int = 6) -> DataFrame:
    """(c, src, i, a, b, len): the first h turns of conversation c - c % ``every``, then c's own after its first h."""
    own = running(turns, ["c"], ["turn", "a", "b"], label="trie-own").withColumnRenamed("rank", "i").drop("turn", "last")
    own = own.withColumn("h", head_turns(F.col("c"), of))
    # of a base at most `of` - 1 turns are needed: one small array
    heads = own.filter((F.col("c") % every == 0) & (F.col("i") < of)).groupBy(F.col("c").alias("base")).agg(
        F.collect_list(F.struct("i", "a", "b", "len")).alias("head")
    )
    taken = convs.withColumn("base", F.col("c") - F.col("c") % every).join(heads, "base")
    taken = taken.select("c", head_turns(F.col("c"), of).alias("h"), F.explode("head").alias("t")).filter("t.i <= h")
    return taken.select("c", F.lit(0).alias("src"), "t.*").unionByName(
        own.filter("i > h").select("c", F.lit(1).alias("src"), "i", "a", "b", "len")
    )


def _cells(a: np.ndarray, b: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each digest in a row of the sketch."""
    z = a + b * np.uint64(2 * row + 1) + np.uint64(0x9E3779B97F4A7C15 * (row + 1) & (2**64 - 1))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(64 - bits)).astype(np.int64)


def _digest(b: pa.RecordBatch, first: str, second: str) -> tuple[np.ndarray, np.ndarray]:
    return tuple(b.column(c).to_numpy().view(np.uint64) for c in (first, second))


def _planes(bits: int):
    def planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests -> for each touched block of the sketch: its cells met, and those met again, as packed bits."""
        size = (1 << bits) // BLOCKS
        pack = zstandard.ZstdCompressor(level=1).compress
        kept, n = [], 0

        def sent() -> pa.RecordBatch:
            out = []
            for row in range(ROWS):
                cells, counts = np.unique(np.concatenate([_cells(*d, row, bits) for d in kept]), return_counts=True)
                cuts = np.searchsorted(cells, np.arange(BLOCKS + 1) * size)
                for block in np.flatnonzero(np.diff(cuts)).tolist():
                    part = slice(cuts[block], cuts[block + 1])
                    met = np.zeros((2, size), bool)
                    met[0, cells[part] - block * size] = True
                    met[1, cells[part][counts[part] > 1] - block * size] = True
                    once, again = (pack(np.packbits(m).tobytes()) for m in met)
                    out.append({"block": row * BLOCKS + block, "once": once, "again": again})
            return pa.RecordBatch.from_pylist(out, pa.schema([("block", pa.int32()), ("once", pa.binary()), ("again", pa.binary())]))

        for b in batches:
            if b.num_rows:
                kept.append(_digest(b, "a_poly", "b_poly"))
                n += b.num_rows
            if n >= FLUSH:
                yield sent()
                kept, n = [], 0
        if kept:
            yield sent()

    return planes


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Planes of the same blocks -> per block the cells met more than once."""
    unpack = zstandard.ZstdDecompressor().decompress
    blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for block, once, again in zip(*(c.to_pylist() for c in b.columns)):
            once, again = (np.frombuffer(unpack(x), np.uint8) for x in (once, again))
            have = blocks.get(block)
            blocks[block] = (once, again) if have is None else (have[0] | once, have[1] | again | (have[0] & once))
    for block, (_, again) in blocks.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([again.tobytes()])], names=["block", "again"])


def sketch(prefixes: DataFrame, max_cells: int = MAX_CELLS) -> tuple[int, list[bytes]]:
    """(bits of a cell's number, per row the packed bits of the cells that count two or more)."""
    n = prefixes.count()
    cells = min(max(MIN_CELLS, CELLS_A_PREFIX * n), max_cells)
    bits = max((cells - 1).bit_length(), BLOCKS.bit_length() + 2)
    planes = prefixes.select("a_poly", "b_poly").mapInArrow(_planes(bits), "block int, once binary, again binary")
    found = planes.repartition("block").mapInArrow(_merged, "block int, again binary")
    rows = [bytearray((1 << bits) // 8) for _ in range(ROWS)]
    size = (1 << bits) // BLOCKS // 8
    for block, again in found.toLocalIterator():  # at most ROWS * BLOCKS blocks, max_cells bits a row
        at = block % BLOCKS * size
        rows[block // BLOCKS][at : at + size] = again
    return bits, [bytes(r) for r in rows]


def _screened(shared):
    def screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds whether a prefix, and the one it extends, may be shared (estimate over one; the root always is)."""
        bits, rows = shared.value
        rows = [np.frombuffer(r, np.uint8) for r in rows]

        def twice(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            out = np.ones(len(a), bool)
            for k, plane in enumerate(rows):
                cell = _cells(a, b, k, bits)
                out &= (plane[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
            return out

        for b in batches:
            own, parent = twice(*_digest(b, "a_poly", "b_poly")), twice(*_digest(b, "a_before", "b_before"))
            parent |= b.column("rank").to_numpy() == 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own), pa.array(parent)], names=[*b.schema.names, "shared", "p_shared"])

    return screened


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pa, pb, c) sorted -> runs of ids of a node as text: (pa, pb, first, ids)"""
    key, ids = None, []

    def chunk() -> pa.RecordBatch:
        row = {"a": key[0], "b": key[1], "first": ids[0], "ids": ",".join(map(str, ids))}
        return pa.RecordBatch.from_pylist([row], pa.schema([("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))

    for b in batches:
        for a, d, c in zip(*(x.to_pylist() for x in b.columns)):
            if ids and ((a, d) != key or len(ids) >= CHUNK_IDS):
                yield chunk()
                ids = []
            key = (a, d)
            ids.append(c)
    if ids:
        yield chunk()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order -> (a, b, ends): SHA-256 of each node's ids; only the hash's state is kept."""
    key, sha = None, None
    done = lambda: pa.RecordBatch.from_arrays(
        [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([sha.hexdigest()])], names=["a", "b", "ends"]
    )
    for batch in batches:
        for a, b, _, ids in zip(*(x.to_pylist() for x in batch.columns)):
            if (a, b) == key:
                sha.update(b"," + ids.encode())
                continue
            if key:
                yield done()
            key, sha = (a, b), hashlib.sha256(ids.encode())
    if key:
        yield done()


def end_hashes(ends: DataFrame) -> DataFrame:
    """(a, b, c) -> (a, b, ends): SHA-256 of each node's ids in ascending order, comma-joined."""
    ordered = ends.repartitionByRange("a", "b", "c").sortWithinPartitions("a", "b", "c")
    chunks = ordered.mapInArrow(_chunks, "a long, b long, first long, ids string")
    return chunks.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_hashed, "a long, b long, ends string")


def trie(turns: DataFrame, convs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """Nodes of the trie of ``turns`` (c, src, i, a, b, len; in the order of src, i) of the conversations ``convs`` (c).

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = turns.sparkSession
    prefixes = running(turns, ["c"], ["src", "i"], digests=["a", "b"], label="trie-prefixes").drop("src", "i", "a", "b")
    shared = spark.sparkContext.broadcast(sketch(prefixes, max_cells))
    rows = prefixes.mapInArrow(
        _screened(shared), ", ".join(f"{c} {t}" for c, t in prefixes.dtypes) + ", shared boolean, p_shared boolean"
    )
    names = {"a_poly": "a", "b_poly": "b", "a_before": "pa", "b_before": "pb", "rank": "depth"}
    rows = stage(rows.withColumnsRenamed(names).withColumn("n_end", F.col("last").cast("long")).drop("last"), "trie-screened")
    single, maybe = rows.filter("not shared"), rows.filter("shared")

    # exact nodes of the possibly shared prefixes
    grouped = maybe.groupBy("a", "b", "depth").agg(
        F.min("c").alias("c"), F.count("*").alias("n_convs"), F.sum("n_end").alias("n_end"), F.min("len").alias("len"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"),
    )
    grouped = stage(grouped, "trie-grouped")
    children = grouped.select("pa", "pb").unionByName(single.filter("p_shared").select("pa", "pb"))
    children = children.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = grouped.join(children, ["a", "b"], "left").select(
        *grouped.columns, F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("len")).alias("saved"),
    ).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    nodes = stage(nodes, "trie-nodes")

    # subtrees: bookings come before the prefix of the same depth, deep ones first
    zero = F.lit(0).cast("long")
    booked = nodes.filter("saved > 0 or leaf > 0").select("c", "depth", "saved", "leaf")
    booked = booked.unionByName(single.filter("n_end > 0").select("c", "depth", zero.alias("saved"), F.lit(1).cast("long").alias("leaf")))
    up = booked.select("*", F.lit(0).alias("kind"), zero.alias("a"), zero.alias("b")).unionByName(
        maybe.select("c", "depth", zero.alias("saved"), zero.alias("leaf"), F.lit(1).alias("kind"), "a", "b")
    )
    up = running(up.withColumn("height", -F.col("depth")), ["c"], ["height", "kind"], sums=["saved", "leaf"], label="trie-subtrees")
    below = up.filter("kind = 1").groupBy("a", "b").agg(F.sum("saved_run").alias("saved_tokens"), F.sum("leaf_run").alias("n_leaves"))

    # members that end at a possibly shared node or have no turn at all
    bare = convs.join(rows.filter("depth = 1").select("c"), "c", "left_anti")
    ends = maybe.filter("n_end > 0").select("a", "b", "c").unionByName(bare.select(zero.alias("a"), zero.alias("b"), "c"))
    ends = stage(end_hashes(ends), "trie-ends")

    # one row of totals is the root
    one = lambda df, c, n, child, leaf, saved: df.select(
        *(x.cast("long").alias(k) for k, x in zip(("c", "n_convs", "n_children", "n_leaves", "saved_tokens"), (c, n, child, leaf, saved)))
    )
    first, none = (F.col("depth") == 1), F.lit(None)
    root = one(convs, F.col("c"), F.lit(1), zero, zero, zero)
    root = root.unionByName(one(nodes, none, zero, first, F.col("leaf"), F.col("saved")))
    root = root.unionByName(one(single, none, zero, first, F.col("n_end"), zero))
    root = root.agg(F.min("c").alias("c"), *(F.sum(c).alias(c) for c in root.columns[1:])).filter("n_convs > 0")
    root = root.select(
        zero.alias("a"), zero.alias("b"), zero.alias("depth"), "c", "n_convs", "n_children", "saved_tokens",
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), none.cast("long").alias("pa"), none.cast("long").alias("pb"),
    )
    out = ["a", "b", "c", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "pa", "pb"]
    exact = nodes.join(below, ["a", "b"]).select(*out).unionByName(root.select(*out))
    exact = stage(exact.join(ends, ["a", "b"], "left").select(*out, "ends"), "trie-exact")

    # singletons are what their row says
    digest = F.sha2(F.when(F.col("n_end") > 0, F.col("c").cast("string")).otherwise(""), 256)
    local = single.select(
        "a", "b", "c", "depth", F.lit(1).cast("long").alias("n_convs"), (1 - F.col("n_end")).alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), "pa", "pb", digest.alias("ends"), "p_shared",
    )

    # a child stands behind its parent; a possibly shared node may hang on a singleton, of its own conversation then
    final = ["c", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    seek = exact.filter("depth > 0").drop("a", "b").unionByName(local.filter("p_shared").drop("a", "b", "p_shared"))
    seek = seek.withColumnsRenamed({"pa": "a", "pb": "b"}).select("*", F.lit(1).alias("kind"), zero.alias("found"), zero.alias("parent"))
    at = exact.select(*seek.columns[: seek.columns.index("kind")], F.lit(0).alias("kind"), F.lit(1).cast("long").alias("found"), F.col("c").alias("parent"))
    met = running(at.unionByName(seek), ["a", "b"], ["kind", "c", "depth"], sums=["found", "parent"], label="trie-parents")
    met = met.filter("kind = 1").withColumn("parent", F.when(F.col("found_run") > 0, F.col("parent_run")).otherwise(F.col("c")))
    nowhere = exact.filter("depth = 0").withColumn("parent", none.cast("long"))
    alone = local.filter("not p_shared").withColumn("parent", F.col("c"))
    found = met.select(*final).unionByName(nowhere.select(*final)).unionByName(alone.select(*final))
    return found.select(
        F.col("c").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, every: int = 100, of: int = 6, max_cells: int = MAX_CELLS) -> DataFrame:
    """The trie of the rebuilt conversations (conv_id, turn, role, text)."""
    turns = stage(turns_of(conversations), "trie-turns")
    convs = stage(turns.groupBy("c").agg(F.count("*").alias("n")).select("c"), "trie-convs")
    return trie(rebuilt_turns(turns, convs, every, of), convs, max_cells)


# the same nodes in DuckDB; a prefix is the text of its turns with their lengths
ORACLE_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL),
crc(c, k, r) AS (SELECT DISTINCT c, 0, 4294967295::BIGINT FROM t UNION ALL
  SELECT c, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM (SELECT c, k,
    CASE WHEN k % 8 = 0 THEN xor(r, ascii((c::VARCHAR)[k // 8 + 1])) ELSE r END AS x FROM crc WHERE k < 8 * length(c::VARCHAR))),
h AS (SELECT c, xor(r, 4294967295) % 6 AS h FROM crc WHERE k = 8 * length(c::VARCHAR)),
r AS (SELECT h.c, 0 AS src, i, role, text FROM h JOIN t ON t.c = h.c - h.c % 100 AND i <= h
  UNION ALL SELECT t.c, 1, i, role, text FROM t JOIN h ON h.c = t.c WHERE i > h),
p AS (SELECT c, role, text, row_number() OVER w AS d,
  string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS k
  FROM r WINDOW w AS (PARTITION BY c ORDER BY src, i)),
m AS (SELECT c, d, sha256(k) AS k, length(text) AS len FROM p UNION ALL SELECT c, 0, '', 0 FROM h),
n AS (SELECT k, d, min(c) AS c, count(*) AS n, any_value(len) AS len FROM m GROUP BY k, d),
f AS (SELECT c, max(d) AS d FROM m GROUP BY c),
e AS (SELECT k, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ids FROM m JOIN f ON f.c = m.c AND f.d = m.d GROUP BY k),
up AS (SELECT DISTINCT x.k, y.k AS pk FROM m x JOIN m y ON y.c = x.c AND y.d = x.d - 1),
kids AS (SELECT pk AS k, count(*) AS n FROM up GROUP BY pk),
below AS (SELECT DISTINCT y.k, x.k AS sub FROM m x JOIN m y ON y.c = x.c AND y.d <= x.d),
tree AS (SELECT below.k, sum((n.n - 1) * n.len) AS saved, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM below JOIN n ON n.k = below.sub LEFT JOIN kids ON kids.k = below.sub GROUP BY below.k)
SELECT n.c AS conv_id, n.d AS depth, q.c AS parent_conv_id, n.n AS n_convs, coalesce(kids.n, 0) AS n_children,
  tree.leaves::BIGINT AS n_leaves, tree.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n JOIN tree ON tree.k = n.k LEFT JOIN up ON up.k = n.k LEFT JOIN n q ON q.k = up.pk
LEFT JOIN kids ON kids.k = n.k LEFT JOIN e ON e.k = n.k"""
