import random
import struct
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from lakeload.llm.packing import CACHE_WORDS, Packer, WordTokenizer, default_tokenizer, pack_documents


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


TEXTS = [
    "Plain words, it's  tabs\tand\nlines 123 4.5!", "É è ÿ ß ½ ² naïve", "", None, "Σίσυφος ς", "日本語 テキスト", "é å",
    "x" * 5000, "soft\xadhyphen nbsp\xa0here \x85 \x1c \x7f", "<|endoftext|> 's 't", "don't I'LL we've", "İstanbul", "😀 ok",
]


def test_ids_equal_the_tokenizer(tokenizer):
    rnd = random.Random(5)
    texts = TEXTS + [" ".join(rnd.choice("ab é's 12 .,-!ÀÿX")[:1] * rnd.randrange(1, 5) for _ in range(200)) for _ in range(50)]
    got = WordTokenizer(default_tokenizer()).encode(texts)
    for t, ids in zip(texts, got):
        want = tokenizer.encode(t, add_special_tokens=False).ids if t else []
        assert np.frombuffer(ids, "<u4").tolist() == want, t


def test_small_cache_is_right_too(tokenizer, monkeypatch):
    monkeypatch.setattr("lakeload.llm.packing.CACHE_WORDS", 5)
    tok = WordTokenizer(default_tokenizer())
    for part in (["one two three four"], ["five six one seven"], ["one two nine ten eleven twelve"]):
        assert np.frombuffer(tok.encode(part)[0], "<u4").tolist() == tokenizer.encode(part[0], add_special_tokens=False).ids


def test_cache_is_bounded_in_words_and_bytes(tokenizer, monkeypatch):
    monkeypatch.setattr("lakeload.llm.packing.CACHE_BYTES", 4000)
    tok = WordTokenizer(default_tokenizer())
    for k in range(30):  # few words, long ones
        text = " ".join(f"{x}{k}" * 100 for x in "abc")
        assert np.frombuffer(tok.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert sum(len(w) + len(ids) for w, ids in tok.cache.items()) < 4000 + 3 * 6000
    assert CACHE_WORDS <= 400_000  # the ids of 1.2 million words took 190 MB in each of an executor's workers


def test_each_different_word_is_cut_once(tokenizer):
    cut, tok = [], WordTokenizer(default_tokenizer())

    class Piece:
        def findall(self, word):
            cut.append(word)
            return WordTokenizer._piece.findall(word)

    tok._piece = Piece()
    texts = [" Ab\x0b c'd\x0c\x0c Ab\t", "  ", None, "\u65e5 Ab", "c'd \xc4b\n\nAb " * 50] * 20
    for _ in range(2):
        for t, ids in zip(texts, tok.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == (tokenizer.encode(t, add_special_tokens=False).ids if t else [])
    assert sorted(filter(None, cut)) == sorted(["ab", "c'd", "\xe4b"] * 2)
    tok.cache.clear()
    assert tok.encode([]) == [] and tok.encode([None, ""]) == [b"", b""]


def test_words_are_gathered_from_one_array(tokenizer):
    tok, words = WordTokenizer(default_tokenizer()), ["don't", "\xc4b12", "plain", "x" * 300]
    ids, begin, size = tok._ids(words)
    for w, b, n in zip(words, begin, size):
        assert ids[b : b + n].tolist() == tokenizer.encode(w, add_special_tokens=False).ids
    assert len(ids) == size.sum() and len(tok._ids([])[0]) == 0


def test_chunks_keep_documents_in_order(make_docs, monkeypatch):
    rows = [(i, f"word{i % 7} é {i} " * (i % 40)) for i in range(300)]
    df = make_docs(rows).coalesce(1)
    want = pack_documents(df).collect()
    monkeypatch.setattr("lakeload.llm.packing.CHUNK", 1)
    assert pack_documents(df).collect() == want and {r.doc_id for r in want} == {i for i, _ in rows}


def check(pieces, docs, capacity):
    """docs: id -> token ids. Every id lies in exactly one piece; sequences are gapless and within capacity."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for doc, start, n, crc, total, seq, off in pieces:
        by_doc[doc].append((start, n, crc, total))
        by_seq[seq].append((off, n))
    assert set(by_doc) == set(docs)
    for d, ps in by_doc.items():
        at = 0
        for start, n, crc, total in sorted(ps):
            ids = docs[d][start : start + n]
            assert start == at and n > 0 and total == len(docs[d]) and crc == crc32(struct.pack(f"<{n}I", *ids))
            at += n
        assert at == len(docs[d])
    padding = 0
    for ps in by_seq.values():
        at = 0
        for off, n in sorted(ps):
            assert off == at
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


@pytest.mark.parametrize("max_open", [3, 1000])
@pytest.mark.parametrize("sizes", ["mixed", "equal", "long"])
def test_packer_keeps_every_id_once(sizes, max_open):
    rnd = random.Random(1)
    pick = {"mixed": lambda: rnd.randrange(1, 200), "equal": lambda: 40, "long": lambda: rnd.randrange(60, 700)}[sizes]
    docs = {i: [rnd.randrange(1 << 32) for _ in range(pick())] for i in range(400)}
    p = Packer(64, 0, max_open)
    for d, ids in docs.items():
        p.add(d, struct.pack(f"<{len(ids)}I", *ids))
        assert p.n_open <= max_open and p.n_open == p.level.sum() == sum(map(len, p.open.values()))
    p.finish()
    assert check(p.out, docs, 64) == 0


def test_places_by_least_sum_of_squares():
    p, rnd = Packer(32, 0, 10_000), random.Random(2)
    for i in range(300):
        size = rnd.randrange(1, 32)
        before, best = p.level.copy(), None
        for h in range(32 - size + 1):
            if h and not before[h]:
                continue
            after = before.copy()
            after[h] -= h > 0
            after[h + size] += h + size < 32
            best = min(best, (after**2).sum()) if best is not None else (after**2).sum()
        p.add(i, bytes(4 * size))
        assert (p.level**2).sum() == best


def test_query_rows(make_docs, tokenizer):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, "long text " * 9000), (101, "a " * 4095), (102, "a " * 4096)]
    got = [tuple(r) for r in pack_documents(make_docs(rows, extra=True)).collect()]
    docs = {i: (tokenizer.encode(t, add_special_tokens=False).ids if t else []) + [2] for i, t in rows}
    assert check(got, docs, 4096) == 0


def test_null_ids_repeats_and_empty_table(make_docs, spark):
    got = pack_documents(make_docs([(None, "a b"), (7, "a b"), (7, "a b")])).collect()
    assert sorted(str(r.doc_id) for r in got if r.start == 0) == ["7", "7", "None"]
    assert sum(r.length for r in got) == 9
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
