"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# one C-level pass over UTF-8 bytes: A-Z to lower case, every byte that is not part of a word to a space
_WORD = set(b"0123456789" + LOWER.encode()) | set(range(0x80, 0x100))
_WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else (b if b in _WORD else 0x20) for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split() if text else []


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` alone would also change other alphabets)."""
    return F.when(F.char_length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def two_hashes(c: Column, first: str, second: str) -> list[Column]:
    """128 hash bits as two longs: differently seeded, so that they do not collide together."""
    return [F.xxhash64(c).alias(first), F.xxhash64(F.lit(0x9E3779B9), c).alias(second)]


def in_training(id_col: str, mod: int, left_out: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, is not ``left_out`` (a null id trains nothing)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod != left_out, F.lit(False))


def held_out(id_col: str, mod: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == remainder, F.lit(False))
