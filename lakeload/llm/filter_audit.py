"""Filter interaction audit: what each of several document filters removes, in every order of applying them.

Measuring. One pass of a table-driven transducer over the UTF-8 bytes of the texts counts words, capitals, code points
and symbols and gives the words' spans. It has two states (between words, inside a word) and five byte classes; the
tables ``_NEXT`` and ``_EMIT`` give the state after a byte and what the byte makes the machine do. The next state
depends on the byte's class alone, so numpy makes all steps of a stretch of bytes at once, by looking up each byte with
its predecessor. The spans go into a hash table that is verified: a span whose hash meets an occupied slot
is compared with the occupant byte by byte, so equal hashes of different words never count as one word. A stretch holds
about ``STRETCH`` bytes: many short texts, or a part of a long one, which ends between words and keeps its table.

Audit. Texts stay in that pass; a document goes on as its id, part, four outcomes and the text's SHA-256. Equal rows are
counted together before anything is shuffled by one key. A document repeats an earlier one unless it holds the
smallest id of its text: the smallest id per text is a map-side combined minimum, joined back on (text, id), so a
text that a third of all documents share lands in no single task. The report needs, per part, the number of documents of
each of the 2^5 outcomes; all 120 orders follow from these numbers.

Nulls and edge cases: a null text is empty; a null part is the empty string; a document with a null id has no label,
repeats nothing and makes nothing a repeat; rows with the same id and text do not repeat each other; labels that
give an id several rows count as 1 where one row says 1; other columns are ignored; an empty table gives no rows.
Texts of any length are measured whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm._common import stage

STRETCH = 1 << 19  # bytes the transducer takes at a time

# byte classes
_GAP, _CAPITAL, _SYMBOL, _OTHER, _REST = range(5)  # _REST: a byte after a code point's first
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _GAP
_CLASS[list(range(0x41, 0x5B))] = _CAPITAL
_CLASS[list(b"#$%&*|")] = _SYMBOL
_CLASS[0x80:0xC0] = _REST

# states: between words, inside a word; the state after a byte of each class
_BETWEEN, _INSIDE = range(2)
_NEXT = np.array([[_BETWEEN, _INSIDE, _INSIDE, _INSIDE, _INSIDE]] * 2, np.uint8)
# what a byte of each class makes the machine do, by state
_BEGIN, _END, _IS_CAPITAL, _IS_SYMBOL, _IS_POINT = (1 << k for k in range(5))
_EMIT = np.array(
    [
        [_IS_POINT, _BEGIN | _IS_CAPITAL | _IS_POINT, _BEGIN | _IS_SYMBOL | _IS_POINT, _BEGIN | _IS_POINT, _BEGIN],
        [_END | _IS_POINT, _IS_CAPITAL | _IS_POINT, _IS_SYMBOL | _IS_POINT, _IS_POINT, 0],
    ],
    np.uint8,
)

# powers of an odd number and of its inverse modulo 2^64: the hash of a span is a difference of running sums
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def transduce(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Run the machine over texts that lie one after the other in ``data``.

    Returns what each byte emitted, begin and end of each word, and the number of the text each word is in.
    """
    kind = _CLASS[data]
    state = np.empty(len(data), np.uint8)
    state[1:] = _NEXT[0][kind[:-1]]  # both rows of the table are alike
    state[starts[starts < ends]] = _BETWEEN
    emitted = _EMIT[state, kind]
    begin = np.flatnonzero(emitted & _BEGIN)
    text = np.searchsorted(ends, begin, side="right")
    # a word ends at the gap that follows it, at the latest with its text
    gaps = np.flatnonzero(emitted & _END)
    after = np.append(gaps, len(data))[np.searchsorted(gaps, begin)]
    return emitted, begin, np.minimum(after, ends[text]), text


class SpanTable:
    """Open-addressing hash table of byte spans, each of an owner; ``insert`` tells which spans were new."""

    def __init__(self):
        self.slots = np.full(1024, -1, np.int64)
        self.begin, self.size, self.owner = (np.zeros(0, np.int64) for _ in range(3))
        self.hash = np.zeros(0, np.uint64)

    def _room(self, more: int) -> None:
        need = 2 * (len(self.begin) + more)
        if need <= len(self.slots):
            return
        self.slots = np.full(1 << int(need - 1).bit_length(), -1, np.int64)
        left, mask = np.arange(len(self.begin)), np.uint64(len(self.slots) - 1)
        at = (self.hash & mask).astype(np.int64)
        while len(left):  # all differ, so no comparison is needed
            free = left[self.slots[at[left]] < 0]
            self.slots[at[free]] = free
            left = left[self.slots[at[left]] != left]
            at[left] = (at[left] + 1) & int(mask)

    def insert(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Spans ``data[begin : begin + size]``; equal spans of one owner are one entry."""
        self._room(len(begin))
        old, mask = len(self.begin), len(self.slots) - 1
        self.begin, self.size = np.concatenate([self.begin, begin]), np.concatenate([self.size, size])
        self.hash, self.owner = np.concatenate([self.hash, hashes]), np.concatenate([self.owner, owner])
        new = np.zeros(len(begin), bool)
        at = (hashes & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(begin))
        while len(left):
            free = left[self.slots[at[left]] < 0]
            self.slots[at[free]] = old + free  # of several, one stays
            holder = self.slots[at[left]]
            won = holder == old + left
            new[left[won]] = True
            left, holder = left[~won], holder[~won]
            left = left[~self._equal(data, old + left, holder)]
            at[left] = (at[left] + 1) & mask
        stay = np.concatenate([np.ones(old, bool), new])
        held = self.slots >= 0
        self.slots[held] = (np.cumsum(stay) - 1)[self.slots[held]]
        self.begin, self.size, self.hash, self.owner = (x[stay] for x in (self.begin, self.size, self.hash, self.owner))
        return new

    def _equal(self, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether entries a and b are the same bytes of the same owner."""
        same = (self.hash[a] == self.hash[b]) & (self.size[a] == self.size[b]) & (self.owner[a] == self.owner[b])
        todo, done = np.flatnonzero(same), 0
        words = np.lib.stride_tricks.as_strided(data.view(np.uint8), (max(0, len(data) - 7), 8), (1, 1))
        while len(todo):
            size, x, y = self.size[a[todo]], self.begin[a[todo]], self.begin[b[todo]]
            far = size > 64  # long words: one comparison each
            for k in np.flatnonzero(far):
                same[todo[k]] = bool(np.array_equal(data[x[k] : x[k] + size[k]], data[y[k] : y[k] + size[k]]))
            todo, size, x, y = todo[~far], size[~far], x[~far] + done, y[~far] + done
            differ = words[x] != words[y]
            differ &= np.arange(8) < (size - done)[:, None]
            bad = differ.any(axis=1)
            same[todo[bad]] = False
            todo, done = todo[~bad & (size > done + 8)], done + 8
        return same


def _stretches(data: np.ndarray, cuts: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text + 1, first byte, end): whole texts of about ``size`` bytes, or a part of a longer one."""
    row, n = 0, len(cuts) - 1
    while row < n:
        if cuts[row + 1] - cuts[row] <= size:
            last = max(row + 1, int(np.searchsorted(cuts, cuts[row] + size, side="right")) - 1)
            yield row, last, int(cuts[row]), int(cuts[last])
            row = last
            continue
        at, stop = int(cuts[row]), int(cuts[row + 1])
        while at < stop:
            end = min(at + size, stop)
            while end < stop:  # a part ends between words
                found = np.flatnonzero(_CLASS[data[end : end + size]] == _GAP)
                if len(found):
                    end = min(end + int(found[0]) + 1, stop)
                    break
                end = min(end + size, stop)
            yield row, row + 1, at, end
            at = end
        row += 1


def measure_bytes(data: np.ndarray, cuts: np.ndarray, size: int = STRETCH) -> dict[str, np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of the texts ``data[cuts[k] : cuts[k + 1]]``.

    ``data`` must go on for 8 bytes behind the last text.
    """
    n = len(cuts) - 1
    out = {k: np.zeros(n, np.int64) for k in ("words", "distinct", "capitals", "points", "symbols")}
    table, last_row = SpanTable(), -1
    power = inverse = np.ones(1, np.uint64)
    for first, last, start, end in _stretches(data, cuts, size):
        part = data[start:end]
        local = np.clip(cuts[first : last + 1], start, end) - start
        emitted, begin, stop, text = transduce(part, local[:-1], local[1:])
        if len(part) >= len(power):
            power, inverse = _powers(_BASE, len(part) + 1), _powers(pow(_BASE, -1, 1 << 64), len(part) + 1)
        sums = np.append(np.uint64(0), np.cumsum((part + np.uint64(1)) * power[: len(part)], dtype=np.uint64))
        hashes = (sums[stop] - sums[begin]) * inverse[begin]
        hashes = (hashes + text.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)) * np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(31)
        if first != last_row:
            table = SpanTable()
        last_row = first if last == first + 1 else -1
        new = table.insert(data, begin + start, stop - begin, hashes, text)
        out["words"][first:last] += np.bincount(text, minlength=last - first)
        out["distinct"][first:last] += np.bincount(text[new], minlength=last - first)
        for name, sign in (("capitals", _IS_CAPITAL), ("points", _IS_POINT), ("symbols", _IS_SYMBOL)):
            seen = np.append(0, np.cumsum((emitted & sign) > 0))
            out[name][first:last] += seen[local[1:]] - seen[local[:-1]]
    return out


_MEASURES = ("words", "distinct", "capitals", "points", "symbols")


def _measure(size: int):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, part, text) -> (doc_id, part, measures, sha256)"""
        for b in batches:
            texts = b.column(2).cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = texts.buffers()[2]
            data = np.zeros(int(offsets[-1] - offsets[0]) + 8, np.uint8)  # 8 more: words are compared eight bytes at a time
            if raw is not None and len(raw):
                data[:-8] = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
            cuts = offsets - offsets[0]
            found = measure_bytes(data, cuts, size)
            view = memoryview(data)
            sha = [hashlib.sha256(view[s:e]).digest() for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(found[m]) for m in _MEASURES), pa.array(sha, pa.binary())],
                names=["doc_id", "part", *_MEASURES, "sha256"],
            )

    return measured


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", stretch: int = STRETCH
) -> DataFrame:
    """Per document: doc_id, part, words, distinct, capitals, points (code points), symbols, sha256 of the text."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    longs = ", ".join(f"{m} long" for m in _MEASURES)
    return rows.mapInArrow(_measure(stretch), f"doc_id {id_type}, part string, {longs}, sha256 binary")


def standard_filters() -> dict[str, Column]:
    """Letter -> failure condition over the measures, in the order of the report."""
    return {
        "A": F.col("words") < 100,
        "B": 100 * F.col("distinct") < 80 * F.col("words"),
        "C": 100 * F.col("capitals") > 10 * F.col("points"),
        "D": F.col("symbols") > 0,
    }


REPEAT = "E"  # the filter of repeated texts, always the last letter


def outcomes(measured: DataFrame, labels: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """Documents by part and outcome: part, mask (bit k: fails filter k, the last one repeats), n, good, toxic."""
    mask = reduce(lambda x, y: x + y, [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(filters.values())], F.lit(0))
    docs = stage(measured.select("doc_id", "part", "sha256", mask.alias("mask")), "audit-measures")
    # repeated rows are one row with a count, before labels and texts deal them by one key
    rows = docs.groupBy("doc_id", "part", "sha256", "mask").agg(F.count("*").alias("n"))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    first = docs.groupBy("sha256").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeats = F.col("first").isNull() & F.col("doc_id").isNotNull()
    known = rows.join(first, ["sha256", "doc_id"], "left").join(marks, "doc_id", "left")
    return known.groupBy("part", (F.col("mask") + F.when(repeats, 1 << len(filters)).otherwise(0)).alias("mask")).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def report(counts: DataFrame, letters: str) -> DataFrame:
    """A row per part, order of the filters and step, from the documents of each outcome."""
    n = len(letters)
    steps = [
        F.struct(
            F.lit("".join(letters[k] for k in order)).alias("filter_order"), F.lit(s + 1).alias("step"),
            F.lit(sum(1 << k for k in order[:s])).alias("before"), F.lit(1 << order[s]).alias("own"),
        )
        for order in permutations(range(n))
        for s in range(n)
    ]
    fails, earlier = F.col("mask").bitwiseAND(F.col("own")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    total = lambda when, what="n": F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")
    # of the orders, a filter comes first of the m that a document fails in one of m
    share = F.expr(f"{factorial(n)}L div bit_count(mask)")
    return (
        counts.withColumn("shapley_n", F.when(F.col("mask") > 0, F.col("n") * share))
        .select("*", F.explode(F.array(*steps)).alias("s")).select("*", "s.*")
        .groupBy("part", "filter_order", "step")
        .agg(
            total(~fails & ~earlier).alias("kept"),
            total(fails & ~earlier).alias("removed"),
            total(fails & earlier).alias("redundant"),
            total(F.col("mask") == F.col("own")).alias("unique_fails"),
            total(fails & ~earlier, "good").alias("good_lost"),
            total(fails & ~earlier, "toxic").alias("toxic_lost"),
            total(fails, "shapley_n").alias("shapley"),
        )
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    filters: dict[str, Column] | None = None,
) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    filters = standard_filters() if filters is None else filters
    measured = measure(docs, id_col, text_col, part_col)
    return report(outcomes(measured, labels, filters), "".join(filters) + REPEAT)


# the same report in DuckDB
ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END)
  + (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END)
  + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END)
  + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
  + (CASE WHEN min(w.doc_id) OVER (PARTITION BY text) < w.doc_id THEN 16 ELSE 0 END) AS mask
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f)
  JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
p AS (SELECT part, own, sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END) AS shapley
  FROM c, s GROUP BY part, own)
SELECT c.part, filter_order, step::INT AS step,
  sum(CASE WHEN mask & (s.own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN mask & s.own > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN mask & s.own > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN mask = s.own THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mask & s.own > 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN mask & s.own > 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
  any_value(shapley)::BIGINT AS shapley
FROM c CROSS JOIN s JOIN p ON p.part = c.part AND p.own = s.own
GROUP BY c.part, filter_order, step"""
