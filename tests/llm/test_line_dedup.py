import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeload.llm import line_dedup as ld
from lakeload.llm.line_dedup import apply_bitmaps, line_bitmaps


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, min_docs=10, mode="all"):
    seen = defaultdict(set)
    first = {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for p, line in enumerate((t or "").split("\n")):
            if key(line):
                seen[key(line)].add((i, t or ""))
                first.setdefault(key(line), (i, t or "", p))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [
            x
            for p, x in enumerate(lines)
            if len(seen.get(key(x), ())) < min_docs or (mode == "rest" and first[key(x)] == (i, t or "", p))
        ]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(docs, **kw):
    df = apply_bitmaps(docs, line_bitmaps(docs, **kw)).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("mode", ["all", "rest"])
def test_equals_brute_force(make_docs, mode):
    rnd = random.Random(3)
    common = ["Home", " home\t", "HOME", "É", "é", "", "  ", "a b", "\x0bx", "unique?"]
    rows = [
        (i, "\n".join(rnd.choice(common) if rnd.random() < 0.7 else f"line {rnd.random()}" for _ in range(rnd.randrange(9))))
        for i in range(120)
    ]
    assert run(make_docs(rows, extra=True), min_docs=10, mode=mode) == brute(rows, mode=mode)
    assert run(make_docs(rows), min_docs=40, mode=mode) == brute(rows, 40, mode)


def test_nulls_repeated_rows_and_very_long_texts(make_docs):
    # repeated rows are one document; a null id and a null text are values like others
    rows = [(i, "same\nown %d" % i) for i in range(9)] + [(0, "same\nown 0")] * 3 + [(None, None), (None, ""), (77, None)]
    assert run(make_docs(rows)) == brute(rows)
    rows += [(None, "same\nnull id"), (500, "same\n" * 50_000 + "x" * 200_000)]
    assert run(make_docs(rows)) == brute(rows)


def test_empty_table(make_docs, spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert run(docs) == []


def test_bitmaps_are_runs(make_docs):
    rows = [(i, f"top\nmenu\nown {i}\nfoot") for i in range(12)]
    got = line_bitmaps(make_docs(rows)).orderBy("doc").collect()
    assert [(r.n_dropped, [tuple(x) for x in r.drops]) for r in got] == [(3, [(0, 2), (3, 1)])] * 12


def test_plan_is_native_and_range_partitioned(make_docs, monkeypatch):
    plans, stage = [], ld.stage
    monkeypatch.setattr(ld, "stage", lambda df, label: plans.append(df._jdf.queryExecution().toString()) or stage(df, label))
    docs = make_docs([(1, "a\nb")])
    plans.append(apply_bitmaps(docs, line_bitmaps(docs))._jdf.queryExecution().toString())
    assert any("rangepartitioning" in p for p in plans)
    assert not any(re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", p) for p in plans)
