"""Queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm import arc_convert, bayes_join, filter_audit, hmm_lm, line_crf, one_bit_ann, prefix_trie
from lakeload.llm import license_scan as lic
from lakeload.llm._common import table
from lakeload.llm.decontaminate import contaminated, decontaminate
from lakeload.llm.line_dedup import apply_bitmaps, line_bitmaps
from lakeload.llm.packing import pack_documents
from lakeload.llm.surrogates import pseudonymise
from lakeload.llm.token_counts import count_tokens

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lic.license_scan(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_bitmaps(docs, line_bitmaps(docs)).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


OP4_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON f.key = k.key GROUP BY doc_id"""


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", contaminated().alias("contaminated")
    )


OP5_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{WORD}') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(ws)) AS m, ws[i+1:i+least(13, len(ws))] AS w
  FROM (SELECT item_id, ws, unnest(range(greatest(1, len(ws) - 12))) AS i FROM b WHERE len(ws) > 0)),
m AS (SELECT DISTINCT m FROM win),
pos AS (SELECT doc_id, m, ws, unnest(range(len(ws) - m + 1)) AS i FROM d, m WHERE len(ws) >= m),
hit AS (SELECT doc_id, item_id, i, pos.m FROM pos JOIN win ON win.m = pos.m AND win.w = pos.ws[i+1:i+pos.m]),
hw AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS x FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN hi ON hi.doc_id = d.doc_id"""


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op9_bayes_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_join.jaccard_join(table(spark, sf_dir, "documents")).drop("text_hash", "class_hash")


def op10_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score_texts(table(spark, sf_dir, "documents"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), key="lakeload example key")


def op6_arc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = arc_convert.pages_round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.score_quality(docs, line_crf.fit_field(docs, table(spark, sf_dir, "labels")))


def op8_one_bit_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit_ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_surrogates": op2_surrogates,
    "op3_line_crf": op3_line_crf,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_arc_convert": op6_arc_convert,
    "op7_pack": op7_pack,
    "op8_one_bit_ann": op8_one_bit_ann,
    "op9_bayes_join": op9_bayes_join,
    "op10_hmm_lm": op10_hmm_lm,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES = {
    "op1_license_scan": lic.oracle_sql(),
    "op4_line_dedup": OP4_SQL,
    "op5_decontaminate": OP5_SQL,
    "op6_arc_convert": arc_convert.ORACLE_SQL,
    "op9_bayes_join": bayes_join.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op13_prefix_trie": prefix_trie.ORACLE_SQL,
}
