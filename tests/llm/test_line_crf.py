import math
from itertools import product

import numpy as np
import pytest

from lakeload.llm import line_crf as crf


def test_line_bins_by_hand():
    text = "Ab ab  ab 12\n\nX|Y !!\n é É"
    bins, size = crf.line_bins(text)
    assert size.tolist() == [12, 0, 6, 6] and bins.shape == (4, len(crf._BINS))
    values = lambda f, line: int(bins[line, f]) - int(crf._FIRST[f])
    at = lambda f, v: int(np.searchsorted(crf._BINS[f], v, side="right"))
    assert values(1, 0) == at(1, 4) and values(8, 0) == at(8, 1 / 4) and values(9, 0) == at(9, 3 / 4)
    assert values(3, 0) == at(3, 1 / 6) and values(5, 0) == at(5, 2 / 12) and values(1, 1) == at(1, 0)
    assert values(6, 2) == at(6, 1 / 2) and values(4, 2) == at(4, 2 / 6) and values(1, 3) == at(1, 2)
    assert crf.line_bins(None)[1].tolist() == [0] and crf.line_bins("")[1].tolist() == [0]
    assert crf.line_bins(" x")[1].tolist() == [2] and len(crf.line_bins("\n")[1]) == 2


@pytest.mark.parametrize("lens", [[1], [4, 1, 2], [3, 3]])
def test_marginals_equal_enumeration(lens):
    rnd = np.random.default_rng(len(lens))
    e, move, lens = rnd.normal(size=sum(lens)), rnd.normal(size=(2, 2)), np.array(lens)
    want, pairs, logz, at = [], np.zeros((2, 2)), 0.0, 0
    for n in lens:
        ys = list(product((0, 1), repeat=int(n)))
        w = [math.exp(sum((y - 0.5) * x for y, x in zip(p, e[at : at + n])) + sum(move[a, b] for a, b in zip(p, p[1:]))) for p in ys]
        z = sum(w)
        want += [sum(x for p, x in zip(ys, w) if p[t]) / z for t in range(n)]
        for p, x in zip(ys, w):
            for a, b in zip(p, p[1:]):
                pairs[a, b] += x / z
        logz, at = logz + math.log(z), at + n
    good, seen, got = crf.marginals(e, lens, move, pairs=True)
    assert np.allclose(good, want) and np.allclose(seen, pairs) and np.isclose(got, logz)


def test_neighbours_count():
    bins = [crf.line_bins(t)[0].astype(int) for t in ("a\nb b b", "c")]
    w = np.random.default_rng(1).normal(size=crf.N_FEATURES)
    got = crf.emissions(np.concatenate(bins), w, np.array([0, 2]))
    n = crf.N_BINS
    own, prev, after = w[:n], w[n : 2 * n], w[2 * n : 3 * n]
    a, b, c = bins[0][0], bins[0][1], bins[1][0]
    want = [own[a].sum() + w[-2] + after[b].sum(), own[b].sum() + prev[a].sum() + w[-1], own[c].sum() + w[-2] + w[-1]]
    assert np.allclose(got, want)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    field = crf.fit_field(docs, labels)
    got = crf.score_quality(docs, field).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50 and sum(r.predicted == r.quality for r in got) >= 0.97 * len(got)
    # training ignores held-out labels: turning them round changes nothing
    turned = labels.withColumn("quality", __import__("pyspark").sql.functions.expr("CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END"))
    again = crf.fit_field(docs, turned)
    assert np.array_equal(field.w, again.w) and field.slope == again.slope


def test_edge_rows(spark, make_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (None, 1), (5, None)], "doc_id long, quality int")
    rows = [(i, "Good text here." if i % 2 else "BAD!! BAD!! ### BAD") for i in range(40)]
    rows += [(None, "x"), (50, None), (51, ""), (52, "word " * 100_000 + "\n" * 50_000), (1, "Good text here."), (1, "Good text here.")]
    docs = make_docs(rows, extra=True)
    field = crf.fit_field(docs, labels)
    got = crf.score_quality(docs, field).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert {r.score for r in got if r.doc_id == 1} == {next(r.score for r in got if r.doc_id == 7)}
    kept = crf.keep_good(docs, field)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    none = crf.fit_field(docs, labels.limit(0))
    assert {r.score for r in crf.score_quality(docs, none).collect()} == {0.5}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert crf.score_quality(empty, field).collect() == [] and crf.keep_good(empty, field).collect() == []


def test_repeated_ids_train_once(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = [(i, "Good text here.\nAnd more." if i % 2 else "BAD!! BAD!! ### BAD") for i in range(40)]
    more = rows + [rows[3]] * 500 + [(3, "### ### 1 2 3")] * 3
    fields = [crf.fit_field(spark.createDataFrame(x, "doc_id long, text string").repartition(n), labels, max_docs=40) for x, n in ((more, 1), (more[::-1], 7))]
    assert np.array_equal(fields[0].w, fields[1].w) and fields[0].slope == fields[1].slope
    assert fields[0].score([rows[1][1]])[0] > 0.7 > fields[0].score([rows[0][1]])[0]


def test_every_line_gets_a_label(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    field = crf.fit_field(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    clean = "The quick meeting of the board was held in the old town hall, and the members agreed on a plan."
    junk = "| a | b | 123 | $$$ ### 99 | | | 55 %% && | x | y |"
    rows = [(1, "\n".join([clean] * 6 + [junk] * 12 + [clean] * 6)), (2, None), (3, "a\n\n" * 3), (None, clean), (4, (clean + "\n") * 2000)]
    got = crf.label_lines(make_docs(rows, extra=True), field).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {i: len(x) for i, x in by.items()} == {1: 24, 2: 1, 3: 7, None: 1, 4: 2001}
    assert all(sorted(r.line for r in x) == list(range(len(x))) for x in by.values())
    assert all(0 <= r.p_good <= 1 and r.good == (r.p_good >= 0.5) for r in got)
    # the labels follow the stretches, and the weighted mean of the lines is the document's quality
    p = {r.line: r.p_good for r in by[1]}
    assert min(p[k] for k in (0, 1, 22, 23)) > max(p[k] for k in (10, 11, 12))
    bins, sizes = crf.line_bins(rows[0][1])
    weight = sizes + 1
    mean = sum(p[k] * w for k, w in enumerate(weight)) / weight.sum()
    score = crf.score_quality(make_docs(rows[:1]), field).first().score
    x = crf._logit(np.array([mean]))
    assert abs(score - (1 / (1 + np.exp(-(field.slope * x + field.shift))))[0]) < 1e-9
    assert crf.label_lines(spark.createDataFrame([], "doc_id long, text string"), field).collect() == []
