"""Rows found by their number without moving them.

A set of numbers that lie close together (surrogate keys) is one bit a number: blocks of 32,768 numbers in 4 KB each. That is
little enough to broadcast where the numbers themselves, or the rows that they stand for, would be shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.operators.numbering import number_rows

MARK = "_ll_mark"
_BLOCK, _BITS, _BEFORE = "_ll_block", "_ll_bits", "_ll_before"
MAX_BLOCKS = 16_384  # 64 MB: the bits of 500 million numbers


def with_mark(df: DataFrame, number: str, numbers: DataFrame, rank: str | None = None) -> DataFrame:
    """``df`` and whether its ``number`` is one of ``numbers`` (different ones, one column of that name; never NULL).

    ``rank`` names one more column: which of ``numbers`` it is, in their order, from 1 (of marked rows; others mean nothing).
    ``df`` is not shuffled unless the numbers lie in more than ``MAX_BLOCKS`` blocks."""
    block, at, more = F.bitmap_bucket_number(number), F.bitmap_bit_position(number), [rank] if rank else []
    if numbers.select(block.alias(_BLOCK)).distinct().limit(MAX_BLOCKS + 1).count() > MAX_BLOCKS:
        found = number_rows(numbers.select(number), [number], rank, unique=True) if rank else numbers.select(number)
        marked = df.join(found.withColumn(MARK, F.lit(True)), number, "left")
        return marked.select(*df.columns, F.coalesce(MARK, F.lit(False)).alias(MARK), *more)
    blocks = numbers.groupBy(block.alias(_BLOCK)).agg(F.bitmap_construct_agg(at).alias(_BITS))
    if rank:  # a window over at most MAX_BLOCKS rows
        before = Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.withColumn(_BEFORE, F.coalesce(F.sum(F.bitmap_count(_BITS)).over(before), F.lit(0)))
    whole, rest = F.floor(at / 8).cast("int"), (at % 8).cast("int")
    byte = F.conv(F.hex(F.substring(_BITS, whole + 1, F.lit(1))), 16, 10).cast("int")
    marked = df.withColumn(_BLOCK, block).join(F.broadcast(blocks), _BLOCK, "left")
    marked = marked.withColumn(MARK, F.coalesce(F.getbit(byte, rest) == 1, F.lit(False)))
    if rank:
        lower = F.bit_count(byte.bitwiseAND(F.pow(F.lit(2), rest + 1).cast("int") - 1))
        marked = marked.withColumn(rank, F.col(_BEFORE) + F.bitmap_count(F.substring(_BITS, F.lit(1), whole)) + lower)
    return marked.select(*df.columns, MARK, *more)
