"""Table configurations: files of concatenated JSON objects (not an array, not one object per line).

``spark.read.json(multiLine=True)`` returns only the first object of such a file, so each file is
read whole (configs are small metadata files; every file is its own task), cut into its objects and parsed with
an explicit schema. Braces inside strings do not count; text that is no object fails the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Object schemas of the three configuration files.
BRONZE_SCHEMA = "source_path string, source_name string, target_path string, target_name string"
# optional: how the landing file is written, and what to do with records that do not fit its header
CSV_SCHEMA = "sep string, quote string, escape string, multi_line boolean, encoding string, on_malformed string"
SILVER_SCHEMA = "notebook_path string, table_name string"
GOLD_SCHEMA = "table_name string"
# what is no brace, with strings as a whole: braces inside a string open and close nothing
_PLAIN = r'[^{}"]++|"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_INNER = rf"(?:{_PLAIN})*+"
for _ in range(4):  # objects in objects, far deeper than a configuration has them
    _INNER = rf"(?:{_PLAIN}|\{{{_INNER}\}})*+"
_OBJECT = rf"\{{{_INNER}\}}"


def read_config(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    body = F.regexp_replace(F.col("value"), "^\uFEFF", "")  # a UTF-8 byte-order mark, if any
    rest = F.trim(F.regexp_replace(F.regexp_replace(body, _OBJECT, ""), r"\s+", " "))
    stray = F.raise_error(F.concat(F.lit("text that is no object in a configuration: "), F.substring(rest, 1, 200)))
    found = F.when(rest == "", F.regexp_extract_all(body, F.lit(_OBJECT), 0)).otherwise(stray.cast("array<string>"))
    objs = text.select(F.explode(found).alias("obj"))
    parsed = objs.select(F.from_json("obj", schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")


def config_records(df: DataFrame) -> list[dict]:
    """Driver-side list of config records (one per table; used to drive a run)."""
    return [r.asDict(recursive=True) for r in df.collect()]
