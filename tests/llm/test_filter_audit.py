import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np

from lakeload.llm import filter_audit as fa

ALPHABET = ["a", "B", "ab", " ", "\n", "\x0b", "\x1c", "é", "日", "#", "|", "x" * 70, "x" * 71 + "y", "\xa0", "\x00"]
MEASURES = ("words", "distinct", "capitals", "points", "symbols")


def brute_measures(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))


def fast(texts, size):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw) + b"\0" * 8, np.uint8)
    found = fa.measure_bytes(data, np.append(0, np.cumsum([len(b) for b in raw])).astype(np.int64), size)
    return list(zip(*(found[m].tolist() for m in MEASURES)))


def text(rnd, n):
    return "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(n)))


def test_transducer_equals_patterns_whatever_the_stretch():
    rnd = random.Random(2)
    for _ in range(100):
        texts = [text(rnd, 60) for _ in range(rnd.randrange(30))]
        for size in (5, 50, 10_000):
            assert fast(texts, size) == [brute_measures(t) for t in texts]


def test_equal_hashes_of_different_words_stay_apart(monkeypatch):
    monkeypatch.setattr(fa, "_BASE", 1)  # a hash is a sum of bytes now: anagrams collide
    texts = ["abc cba bca abc", "x" * 100 + "ab " + "x" * 100 + "ba", ""]
    assert fast(texts, 1000) == [brute_measures(t) for t in texts]


def brute(rows, labels):
    """rows of (doc_id, text, lang)"""
    good, toxic = defaultdict(bool), defaultdict(bool)
    for i, q, t in labels:
        if i is not None:
            good[i] |= q == 1
            toxic[i] |= t == 1
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    docs = []
    for i, t, lang in rows:
        w, d, cap, n, s = brute_measures(t or "")
        fails = {"A": w < 100, "B": 100 * d < 80 * w, "C": 100 * cap > 10 * n, "D": s > 0,
                 "E": i is not None and first[t or ""] < i}
        docs.append((lang or "", {f for f in fails if fails[f]}, good[i], toxic[i]))
    out, shapley = [], defaultdict(int)
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                out.append((part, "".join(order), k + 1, len(left), len(gone), sum(f in d[1] for d in mine) - len(gone),
                            sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def run(spark, rows, labels):
    docs = spark.createDataFrame(
        [(*r, 1, "s", True) for r in rows], "doc_id long, text string, lang string, words int, sha256 string, first boolean"
    )
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    return sorted(map(tuple, fa.audit(docs.repartition(4), marks).collect()))


def test_report_equals_brute_force(spark):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(150):
        t = " ".join(rnd.choice(words[: rnd.choice([40, 400])]) for _ in range(rnd.choice([50, 150, 200])))
        t = t.upper() if rnd.random() < 0.3 else t
        rows.append((i, t + rnd.choice(["", "", " #"]), rnd.choice(["en", "de", None, ""])))
    rows += [(200 + k, rows[k % 20][1], "en") for k in range(60)]
    rows += [(None, rows[0][1], "en"), (None, None, None), (7, "", "de"), (7, None, "de"), (3, rows[3][1], rows[3][2]), (900, "Long # " * 50_000, "en")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 250, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 1)]) == []
    rows = [(1, "a", "en"), (2, "a", "en")]
    assert run(spark, rows, []) == brute(rows, [])


def test_every_part_has_every_order_and_step(spark):
    got = run(spark, [(1, "a", "x"), (2, "b", None)], [])
    assert len(got) == 2 * 120 * 5 and {r[0] for r in got} == {"x", ""}
