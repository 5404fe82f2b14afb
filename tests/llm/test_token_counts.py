import random

import pytest
from pyspark.sql import functions as F

from lakeload.llm import token_counts as tc
from lakeload.llm.queries import op12_token_counts
from tests.llm.conftest import SF001

ALPHABET = ["a", "b", " ", "  ", "▁", "\n", "中", "国", "é", "😀", "<s>", "\t", "\x00", "th", "e", "ing", "́", "　"]


@pytest.fixture(scope="module")
def counter():
    return tc.PieceCounter(tc.default_model())


def brute(counter, text):
    return len(counter.model.encode(text or ""))


def test_cuts_at_safe_places_keep_the_count(counter):
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(60)))
        sides = counter.split(text, rnd.randrange(1, 9))
        assert "".join(sides) == text
        n = counter.encode_lengths([tc._LEAD + s if k else s for k, s in enumerate(sides)])
        assert sum(n) - counter.lead * (len(sides) - 1) == brute(counter, text)


def test_a_text_without_safe_places_stays_whole(counter):
    assert counter.split("e" * 1000, 10) == ["e" * 1000]
    assert len(counter.split("word and " * 1000, 100)) > 50


def test_rows(spark, make_docs, counter):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(200)))) for i in range(200)]
    rows += [(None, "a b"), (None, None), (7, None), (8, ""), (9, "same"), (9, "same"), (11, "long text, " * 40_000), (12, "e" * 30_000)]
    for kw in ({}, {"piece_chars": 10, "batch_bytes": 50}):
        got = tc.count_tokens(make_docs(rows, extra=True), **kw).collect()
        want = [(i, len((t or "").encode()), brute(counter, t), brute(counter, t) > 4096) for i, t in rows]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert tc.count_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_whole_texts(spark, counter):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, len(r.text.encode()), brute(counter, r.text), brute(counter, r.text) > 4096) for r in docs)
    got = op12_token_counts(spark, SF001)
    assert sorted(map(tuple, got.collect())) == want
    assert "MapInArrow" in got.filter(F.lit(True))._jdf.queryExecution().executedPlan().toString()
