import math
import random
from collections import Counter
from itertools import product
from zlib import crc32

import numpy as np
import pytest

from lakeload.llm import hmm_lm as lm


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def toks(t):
    out, cur = [], ""
    for c in low(t):
        if c in " \t\n\x0b\x0c\r":
            out, cur = out + [cur] * bool(cur), ""
        else:
            cur += c
    return out + [cur] * bool(cur) + [None]


def trains(i):
    return i is not None and crc32(str(i).encode()) % 5 != 1


def base(rows):
    c = Counter(w for i, t in rows if trains(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    return sorted(
        (
            (i, i is not None and not trains(i), len(toks(t)), sum(c[w] > 0 for w in toks(t)), n,
             round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in toks(t)), 6))
            for i, t in rows
        ),
        key=str,
    )


def run(docs, **kw):
    return lm.score_texts(docs, **{"block_tokens": 50, "iterations": 2, "states": 3, "min_count": 5, **kw}).collect()


def digest(got):
    return sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=str)


VOCAB = ["the", "The", "éa", "ÉA", "x.", "b\x1cb", "c\xa0d", "日本", "a" * 50]


def corpus(n=120, seed=4, length=30):
    rnd = random.Random(seed)
    words = VOCAB + [f"w{k}" for k in range(80)]
    glue = lambda: rnd.choice([" ", "\t", "\n", "  ", "\r\x0b\x0c"])
    return [(i, "".join(rnd.choice(words) + glue() for _ in range(rnd.randrange(length)))) for i in range(n)]


def test_counts_and_base_score(make_docs):
    rows = corpus() + [(None, "the x."), (None, None), (7, None), (8, ""), (9, "the the"), (9, "the the"), (11, "w1 " * 30_000)]
    got = run(make_docs(rows, extra=True))
    assert digest(got) == base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_empty_and_untrained(make_docs, spark):
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []
    rows = [(None, "a b"), (None, None)]
    assert digest(run(make_docs(rows))) == base(rows)


# ---------------------------------------------------------------- the chain against enumeration
def small(states=3, words=4, seed=1):
    rnd = np.random.default_rng(seed)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    return lm.Chain(norm(rnd.random(states)), norm(rnd.random((states, states)))), norm(rnd.random((states, words))).T.copy()


def paths(m, emit, seq):
    for p in product(range(len(m.start)), repeat=len(seq)):
        x = m.start[p[0]] * emit[seq[0], p[0]]
        for t in range(1, len(seq)):
            x *= m.move[p[t - 1], p[t]] * emit[seq[t], p[t]]
        yield p, x


@pytest.mark.parametrize("seqs", [[[0]], [[1, 2, 3], [0], [3, 3, 1, 0, 2]], [[2, 1]] * 3])
def test_forward_and_counts_equal_enumeration(seqs):
    m, emit = small()
    lens, flat = np.array([len(s) for s in seqs]), np.concatenate(seqs)
    want, start, move, out = [], np.zeros(3), np.zeros((3, 3)), np.zeros((3, 4))
    for s in seqs:
        total = sum(x for _, x in paths(m, emit, s))
        want.append(math.log10(total))
        for p, x in paths(m, emit, s):
            start[p[0]] += x / total
            for t in range(len(s)):
                out[p[t], s[t]] += x / total
                if t:
                    move[p[t - 1], p[t]] += x / total
    assert np.allclose(m.forward(emit, flat, lens), want)
    got = m.expected(emit, flat, lens, np.arange(4), 4)
    for x, y in zip(got, (start, move, out, sum(want))):
        assert np.allclose(x, y)
    grouped = m.expected(emit, flat, lens, np.array([1, 0, 1, 0]), 2)[2]
    assert np.allclose(grouped, np.stack([out[:, [1, 3]].sum(axis=1), out[:, [0, 2]].sum(axis=1)], axis=1))


def test_pieces_count_like_whole_sequences():
    rnd = np.random.default_rng(3)
    m, emit = small(4, 30, 2)
    lens = np.array([700, 3, 64, 65, 1, 129])
    seq = rnd.integers(0, 30, lens.sum())
    whole = m.expected(emit, seq, lens, np.arange(30), 30, segment=10_000)
    cut = m.expected(emit, seq, lens, np.arange(30), 30, segment=64, context=40)
    for x, y in zip(whole, cut):
        assert np.allclose(x, y, atol=1e-6)
    assert np.isclose(cut[1].sum(), (lens - 1).sum()) and np.isclose(cut[0].sum(), len(lens))
    begin, size, core, stop = lm.pieces(np.array([5, 12]), 5, 2)
    assert list(zip(begin, size, core, stop)) == [(0, 5, 0, 5), (5, 7, 0, 5), (8, 9, 2, 7), (13, 4, 2, 4)]


# ---------------------------------------------------------------- the fit over Spark against one process
def one_process(rows, states, iterations, min_count):
    """The same Baum-Welch with dictionaries over all training texts at once; (id, score) of every text."""
    seqs = [[w if w is not None else "END" for w in (x.encode() if x is not None else None for x in toks(t))] for _, t in rows]
    train = [k for k, (i, _) in enumerate(rows) if trains(i)]
    c = Counter(w for k in train for w in seqs[k])
    vocab = sorted({w for s in seqs for w in s}, key=str)
    number = {w: k for k, w in enumerate(vocab)}
    n, v, ends = sum(c.values()), len(c), c["END"]
    few = lm.levels(min_count) + 1
    own = [w for w in vocab if w != "END" and c[w] >= min_count]
    group = np.array([
        few - 1 if w == "END" else few + own.index(w) if c[w] >= min_count else int(lm.level(np.array([c[w]]))[0]) for w in vocab
    ])
    shares = np.concatenate([
        lm.first_shares(np.arange(few, dtype=np.uint64), states), lm.first_shares(np.array([crc32(w) for w in own], np.uint64), states)
    ])
    counts = np.array([c[w] for w in vocab])
    flat = lambda ks: (np.array([number[w] for k in ks for w in seqs[k]]), np.array([len(seqs[k]) for k in ks]))
    chain, p = lm.Chain.initial(states), np.full(states, 1 / states)
    for _ in range(iterations):
        emit = lm.Corpus(chain, p, None, n, v, ends, min_count).emissions(shares[group], counts)
        start, move, out, _ = chain.expected(emit, *flat(train), group, few + len(own), segment=10**9)
        chain, p = lm.Chain.estimate(start, move), out.sum(axis=1) / n
        seen = out.sum(axis=0)
        shares = np.where(seen > 0, out / np.where(seen > 0, seen, 1), 1 / states).T
    emit = lm.Corpus(chain, p, None, n, v, ends, min_count).emissions(shares[group], counts)
    scores = chain.forward(emit, *flat(range(len(rows))))
    return sorted((i, x) for (i, _), x in zip(rows, scores))


@pytest.mark.parametrize("block_tokens,min_count", [(200, 1), (200, 12), (10**6, 12)])
def test_the_distributed_fit_equals_one_process(make_docs, block_tokens, min_count):
    rows = corpus(150, 9, 60)
    fit = lambda width: sorted(
        (r.doc_id, r.score)
        for r in run(make_docs(rows), block_tokens=block_tokens, min_count=min_count, iterations=3, tolerance=-1, share_bytes=width)
    )
    got = fit(4)
    want = one_process(rows, 3, 3, min_count)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], rtol=1e-5)  # it adds up in single precision
    assert np.allclose([x for _, x in fit(1)], [x for _, x in want], rtol=5e-3)  # what the query takes


def test_equal_texts_score_alike(make_docs):
    got = {r.score for r in run(make_docs([(i, "the x.") for i in range(40)]), states=2)}
    assert max(got) - min(got) < 1e-9


def test_emissions_are_a_distribution():
    rnd = np.random.default_rng(2)
    c = np.array([40, 7, 7, 3, 1, 0])  # five known words and the unknown one
    shares = rnd.random((6, 3))
    shares /= shares.sum(axis=1, keepdims=True)
    p = (shares * c[:, None]).sum(axis=0) / c.sum()
    emit = lm.Corpus(None, p, None, int(c.sum()), 5, 3, 10).emissions(shares, c)
    assert np.allclose(emit.sum(axis=0), 1)


def test_one_state_gives_every_word_its_corpus_share(make_docs):
    rows = corpus() + [(500, "never seen")]
    assert all(abs(r.score - r.base_score) < 1e-6 for r in run(make_docs(rows), states=1))


def test_scores_held_out_texts_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for min_count, least in ((100, 0.12), (5, 0.23)):
        got = [r for r in lm.score_texts(docs, min_count=min_count).collect() if r.held_out]
        assert sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got) > least


def test_packed_numbers_round_trip():
    for a in ([], [0], [1, 70_000, 2**32 - 1]):
        assert lm._unpack(lm._pack(np.array(a, np.uint32))).tolist() == a
    x = np.array([[1.0, 3.0], [0, 0], [5, 0]])
    for width, atol in ((1, 2e-3), (2, 1e-4), (4, 1e-8)):
        assert np.allclose(lm._unpack_shares(lm._pack_shares(x, width), 2, width), [[0.25, 0.75], [0, 0], [1, 0]], atol=atol)


def test_levels():
    assert lm.level(np.array([0, 1, 2, 3, 4, 7, 8])).tolist() == [0, 1, 2, 2, 3, 3, 4]
    assert [lm.levels(k) for k in (1, 2, 3, 100)] == [1, 2, 3, 8]


def test_every_frequent_word_has_a_profile_of_its_own(make_docs):
    # two topics of 10,000 words each: far more words than any fixed number of classes, all learned by topic
    rnd = random.Random(5)
    topic = [[f"{t}{k}" for k in range(10_000)] for t in "ab"]
    rows = [(i, " ".join(rnd.choice(topic[i % 2]) for _ in range(1500))) for i in range(100)]
    got = [r for r in run(make_docs(rows), states=2, iterations=20, tolerance=-1, block_tokens=40_000, min_count=1) if r.held_out]
    gain = sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got)
    assert len(got) > 10 and gain > 0.9 * math.log10(2)
