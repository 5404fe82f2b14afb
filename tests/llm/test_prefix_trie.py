import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest
import xxhash
from pyspark.sql import functions as F

from lakeload.llm import prefix_trie as pt
from lakeload.llm import running as rn
from lakeload.llm.queries import op13_prefix_trie
from tests.llm.conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            tie = xxhash.xxh64_intdigest(text or "", xxhash.xxh64_intdigest(role or "", 42))
            convs[c].append((turn is not None, turn or 0, (tie + 2**63) % 2**64, role or "", text or ""))
    for v in convs.values():
        v.sort()
    nodes = defaultdict(lambda: ([], []))
    for c in list(convs):
        h, base = crc32(str(c).encode()) % 6, c - (c % 100 if c >= 0 else -(-c % 100))
        t = [x[3:] for x in convs.get(base, [])[:h] + convs[c][h:]]
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])][0].append(c)
        nodes[tuple(t)][1].append(c)
    kids = defaultdict(list)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    total = {}
    for k in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[k][0]) - 1) * len(k[-1][1]) if k else 0
        total[k] = (sum(total[x][0] for x in kids[k]) or 1, own + sum(total[x][1] for x in kids[k]))
    return sorted(
        (
            (min(m), len(k), min(nodes[k[:-1]][0]) if k else None, len(m), len(kids[k]), *total[k],
             hashlib.sha256(",".join(map(str, sorted(e))).encode()).hexdigest())
            for k, (m, e) in nodes.items()
        ),
        key=str,
    )


def rows_of(seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(40), *range(100, 140), 200, 250, -5, -100, -130, 777, 10**12]:
        for t in range(rnd.randrange(1, 9)):
            turn = t if rnd.random() < 0.9 else None
            rows.append((c, turn, rnd.choice(["u", "a", None]), rnd.choice(["x", "yy", "", None, "日本", "z" * 5000])))
    rows += [(c, t, "u", "hot") for c in range(300, 330) for t in range(7)]  # one conversation many times
    rows += [(c, 0, "system", "common") for c in range(410, 450)] + [(c, t, "u", f"{c}") for c in range(410, 450) for t in range(1, 9)]
    return rows + [(5, t, "u", f"w{t % 3}") for t in range(60)] + [(None, 0, "u", "x")] + rows[:20]


def run(df, **kw):
    return sorted((tuple(r) for r in pt.conversation_trie(df, **kw).collect()), key=str)


@pytest.fixture()
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_nodes_equal_brute_force(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", a int, shared string, depth int").repartition(5)
    assert run(df) == brute(rows)


def test_a_full_sketch_changes_nothing(spark, many_partitions, monkeypatch):
    monkeypatch.setattr(pt, "MIN_CELLS", 1)
    rows = rows_of(4)
    assert run(spark.createDataFrame(rows, SCHEMA), max_cells=1) == brute(rows)


def test_empty_and_turnless(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    c = next(c for c in range(1, 99) if crc32(str(c).encode()) % 6 > 0)
    rows = [(c, None, None, None), (c + 1000, 3, "u", "x")]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert run(spark.createDataFrame(rows[:1], SCHEMA)) == brute(rows[:1])  # the root alone, childless


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, op13_prefix_trie(spark, SF001).collect()), key=str) == brute(map(tuple, rows))


def test_estimates_never_fall_below_counts(spark):
    rnd = random.Random(1)
    keys = [(rnd.getrandbits(62), rnd.getrandbits(62)) for _ in range(300)]
    rows = [k for n, k in enumerate(keys) for _ in range(1 + n % 3)]
    df = spark.createDataFrame(rows, "a_poly long, b_poly long").repartition(7)
    shared = spark.sparkContext.broadcast(pt.sketch(df))
    seen = df.select("*", F.col("a_poly").alias("a_before"), F.col("b_poly").alias("b_before"), F.lit(2).cast("long").alias("rank"))
    schema = "a_poly long, b_poly long, a_before long, b_before long, rank long, shared boolean, p_shared boolean"
    got = {(r.a_poly, r.b_poly): r.shared for r in seen.mapInArrow(pt._screened(shared), schema).collect()}
    assert all(got[k] for n, k in enumerate(keys) if n % 3)
    assert sum(got[k] for n, k in enumerate(keys) if n % 3 == 0) < 20


def test_running_totals_over_cut_groups(spark, many_partitions):
    rnd = random.Random(6)
    rows = [(rnd.choice([1, 2, 2, 2, 2, 2, 2, 3, -4, 2**40]), k, rnd.getrandbits(63) - 2**62) for k in range(3000)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    df = df.withColumn("w", F.col("v") + 1)
    got = rn.running(df, ["g"], ["o"], sums=["v"], digests=["w", "v"]).collect()
    wrap = lambda x: (x + 2**63) % 2**64 - 2**63
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: r[1]):
        by[r[0]].append(r)
    want = {}
    for g, rs in by.items():
        s, polys = 0, [0, 0]
        for k, (_, o, v) in enumerate(rs):
            before = list(polys)
            s, polys = s + v, [p + x * b**k for p, x, b in zip(polys, (v + 1, v), rn.BASES)]
            polys = [p % 2**64 for p in polys]
            want[g, o] = (k + 1, wrap(s), *map(wrap, polys), *map(wrap, before), k == len(rs) - 1)
    assert len(got) == len(rows)
    assert {(r.g, r.o): (r["rank"], r.v_run, r.w_poly, r.v_poly, r.w_before, r.v_before, r["last"]) for r in got} == want
