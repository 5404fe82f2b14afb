import hashlib
import random

import pytest

from lakeload.llm._common import words
from lakeload.llm.decontaminate import WuManber, contaminated, decontaminate, item_windows


def brute(rows, items, window=13):
    pats = item_windows(items, window)
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for p, ids in pats.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    found |= set(ids)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = decontaminate(docs, bench, **kw)
    df = df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", contaminated())
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(rnd, n, alphabet):
    return " ".join(rnd.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize("alphabet", [["a", "B"], ["a", "b", "c-d", "é", "É", "x9"], [f"w{i}" for i in range(60)]])
@pytest.mark.parametrize("block", [500_000, 40])
def test_equals_brute_force(spark, make_docs, alphabet, block):
    rnd = random.Random(len(alphabet))
    items = [(i, sample(rnd, rnd.choice([0, 1, 2, 5, 12, 13, 14, 30]), alphabet)) for i in range(14)] + [(3, "a a b"), (None, "q r s")]
    rows = [(i, sample(rnd, rnd.randrange(60), alphabet) + " " + rnd.choice(items)[1]) for i in range(30)]
    rows += [(1, None), (None, ""), (5, rows[0][1]), (5, rows[0][1])]
    # several blocks: the patterns of one scan are bounded, further ones are further scans
    assert run(spark, make_docs(rows, extra=True), items, max_block_windows=block) == brute(rows, items)


def test_small_windows(spark, make_docs):
    items = [(1, "a b a b a"), (2, "b a b")]
    rows = [(0, "a b a b a b a"), (1, "b a"), (2, "x " * 100_000 + "b a b")]
    for window in (1, 2, 3, 4):
        assert run(spark, make_docs(rows), items, window=window) == brute(rows, items, window)


def test_empty_tables(spark, make_docs):
    assert run(spark, spark.createDataFrame([], "doc_id long, text string"), [(1, "a b")]) == []
    assert run(spark, make_docs([(1, "a b")]), []) == brute([(1, "a b")], [])
    assert run(spark, make_docs([(1, "a b")]), [(1, None), (2, "...")]) == brute([(1, "a b")], [])


def test_scan_skips_ordinary_text():
    find = WuManber(item_windows([(1, sample(random.Random(1), 40, [f"p{i}" for i in range(30)]))], 13))
    looked = []

    class Counted(list):
        def __getitem__(self, i):
            looked.append(i)
            return super().__getitem__(i)

    assert list(find.search(Counted(words("ordinary words " * 5000)))) == []
    assert len(looked) <= 10_000 / 13 + 1


def test_copies_of_an_item_are_spread_over_blocks(spark, make_docs):
    text = ",".join(f"w{k}" for k in range(20))  # no white space: words are counted by the word rule
    items = spark.createDataFrame([(f"i{k}", text) for k in range(12)] + [(None, None)], "item_id string, text string")
    docs = make_docs([(1, f"before {text} after"), (2, "clean text"), (3, None)])
    whole = {r.doc_id: r for r in decontaminate(docs, items).collect()}
    cut = {r.doc_id: r for r in decontaminate(docs, items, max_block_windows=9).collect()}
    assert whole == cut and (whole[1].n_words, whole[1].n_hit, whole[1].n_items) == (22, 20, 12)
    assert whole[1]["items"] == sorted(f"i{k}" for k in range(12)) and whole[2].n_hit == whole[3].n_words == 0


def test_one_broadcast_at_a_time(spark, make_docs, monkeypatch):
    rnd = random.Random(7)
    items = [(i, sample(rnd, 40, [f"w{k}" for k in range(30)])) for i in range(20)]
    rows = [(i, items[i % 20][1]) for i in range(30)] + [(None, items[0][1])] * 3 + [(40, "clean")]
    live, most, put = set(), [0], type(spark.sparkContext).broadcast

    def broadcast(sc, value):
        b = put(sc, value)
        live.add(id(b))
        most[0] = max(most[0], len(live))
        gone = b.destroy
        b.destroy = lambda *a: (live.discard(id(b)), gone(*a))
        return b

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    got = run(spark, make_docs(rows), items, max_block_windows=100)
    assert got == brute(rows, items) and most[0] == 1 and not live
