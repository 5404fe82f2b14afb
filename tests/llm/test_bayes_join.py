import random

import numpy as np
import pytest

from lakeload.llm import bayes_join as bj
from lakeload.llm._common import words
from lakeload.llm.components import connected


def sets(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    same, sh = {}, [sets(t) for _, t in rows]
    key = [b" ".join(words(t)) for _, t in rows]
    for k in key:
        same[k] = same.get(k, 0) + 1
    ids = {}
    for (i, _), k in zip(rows, key):
        if i is not None:
            ids[k] = min(i, ids.get(k, i))
    distinct = {k: s for k, s in zip(key, sh)}
    links = {k: set() for k in distinct}
    for a in distinct:
        for b in distinct:
            if a != b and distinct[a] and distinct[b]:
                both = len(distinct[a] & distinct[b])
                if 5 * both >= 4 * (len(distinct[a]) + len(distinct[b]) - both):
                    links[a].add(b)
    out = []
    for (i, _), k in zip(rows, key):
        group, todo = {k}, [k]
        while todo:
            for b in links[todo.pop()] - group:
                group.add(b)
                todo.append(b)
        known = [ids[b] for b in group if b in ids]
        n = sum(same[b] for b in links[k])
        out.append((i, min(known) if known else None, ids.get(k), same[k], len(links[k]), same[k] - 1 + n))
    return sorted(out, key=str)


def run(docs, **kw):
    return sorted((tuple(r) for r in bj.jaccard_join(docs, **kw).drop("text_hash", "class_hash").collect()), key=str)


def corpus(seed=1, groups=6):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)] + ["Été", "été", "x-y"]
    rows, passage = [], " ".join(rnd.choice(vocab) for _ in range(40))
    for _ in range(groups):
        text = [rnd.choice(vocab) for _ in range(rnd.randrange(3, 150))]
        for _ in range(rnd.randrange(1, 14)):
            t = list(text)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            rows.append(" ".join(t) + (" " + passage if rnd.random() < 0.3 else ""))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [1024, 3])
def test_equals_brute_force(make_docs, block):
    rows = corpus() + [(900, "a b"), (901, "A, B."), (902, "a b c"), (903, "one two three four five"), (None, None), (904, "")]
    # small blocks: groups are dealt to the tasks of all pairs of blocks
    assert run(make_docs(rows, extra=True), block=block) == brute(rows)


def test_nulls_repeats_long_texts_and_empty_table(make_docs, spark):
    rnd = random.Random(9)
    long = " ".join(f"v{rnd.randrange(5000)}" for _ in range(60_000))
    rows = [(None, "x y z"), (None, "x y z"), (5, "X Y z"), (5, "X Y z"), (5, "other text"), (None, "alone here"),
            (70, long), (71, long.replace("v77", "q")), (72, "same " * 50_000)]
    assert run(make_docs(rows)) == brute(rows)
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []


def test_shingle_hashes_agree_with_sets():
    rnd = random.Random(2)
    for n in (0, 1, 4, 5, 6, 200):
        t = " ".join(rnd.choice(["aa", "b", "ccc", "é"]) for _ in range(n))
        assert len(bj.shingles(b" ".join(words(t)))) == len(sets(t))


def test_posterior_drops_only_below_tolerance():
    steps = [25, 100, 200]
    for n, m in zip(steps, bj.least_matches(0.8, 1e-6, steps)):
        # a pair at the threshold falls under the bound with about the tolerance
        tail = sum(__import__("math").comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(m))
        assert tail < 1e-5 and 0 < m < 0.8 * n


def test_minhash_estimates_jaccard():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 2**63, 4000, np.uint64)
    for both, only in ((800, 100), (500, 250), (100, 450)):
        got = [
            (bj.minhash(x[s : s + both + only]) == bj.minhash(np.concatenate([x[s : s + both], x[s + both + only : s + both + 2 * only]]))).mean()
            for s in range(0, 2000, 100)
        ]
        assert abs(np.mean(got) - both / (both + 2 * only)) < 0.02


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, kind):
    rnd = random.Random(3)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(100)],
        "random": [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)],
    }[kind]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    want = sorted((x, root(x)) for x in list(up))
    got = sorted(tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == want
