"""The registered queries against their SQL, and the registration itself."""

import re

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from lakeload.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SF001


def test_one_query_per_operator_and_the_pipeline():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) < set(queries()) and set(ORACLES) < set(oracle_sql())
    assert queries()["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5


def norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    df = QUERIES[name](spark, SF001)
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(map(norm, r)) for r in df.select(*columns).collect()]
    assert sorted(got, key=str) == sorted((tuple(map(norm, r)) for r in want.fetchall()), key=str)
