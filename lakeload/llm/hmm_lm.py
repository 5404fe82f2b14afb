"""Language-model scoring with a hidden Markov model over words.

A text is its words (runs of characters other than ASCII white space, A-Z lower-cased) and one end token. Latent
states emit words, each word with a profile: the shares of the states in the word's training tokens. With c the word's
training count, r the share of a state in its profile, n the training tokens, v their distinct words and p the state's
share of all tokens, P(word | state) = (c * r + p / 2 + PRIOR * q) / (p * N + PRIOR), where N = n + (v + 1) / 2 and
q = (c + 1/2) / N is the word's corpus share. That is a distribution over all known words and one unknown word; one
state gives q itself. Words met ``min_count`` times or more in training have a profile of their own, however many they
are; rarer words share the profile of their count's level (1, 2-3, 4-7, ...), and so do unknown words (level 0).

1. Documents are cut by task into blocks of about ``BLOCK_TOKENS`` tokens: word numbers local to the block, and
   the block's vocabulary with its training counts. Blocks are written once.
2. Corpus counts: a row per block and word is dealt by word and sorted; the sums stream through a task and go back to the
   blocks as packed numbers. A word has at most a row per block, so no word is a hot key.
3. Blocks and counts are written bucketed by block, so that no iteration shuffles a text again.
4. Baum-Welch: each iteration broadcasts start, moves, the states' and the levels' shares (of fixed size). A block's
   expected counts of words with their own profile go to the words' part as packed numbers; the part's sums go back, as
   profiles, to the blocks that hold the word. Iterations end at ``ITERATIONS``, or when a token gains less than
   ``TOLERANCE`` in log10 likelihood.
   Sequences over ``SEGMENT`` tokens are trained in pieces that see ``CONTEXT`` tokens more on both sides: those are
   not counted, they only tell the states at the borders, so that the moves between pieces count and no piece begins anew.
5. Scoring: the scaled forward recursion over each whole text gives its exact log likelihood.

Training rows are those whose crc32 of the id as text leaves another remainder than the one held out; a null id
neither trains nor is held out. A null or empty text is the end token alone. Repeated rows count and are scored
each. Other columns are ignored. Texts of any length are scored whole; one longer than a block is a block. Ties do not
arise. Without training tokens every share is 1/2 over 1/2 and the states are uniform.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm._common import held_out, in_training, stage
from lakeload.session import scratch_path
from lakeload.sources.fs import delete_path

STATES, ITERATIONS, TOLERANCE = 8, 4, 1e-4
PRIOR = 1000.0  # tokens' worth of the corpus shares in every state's emissions
MIN_COUNT = 100
BLOCK_TOKENS, SEGMENT, CONTEXT = 5_000_000, 512, 48
BATCH_TOKENS = 1 << 18  # tokens of pieces trained side by side
FLUSH_ROWS = 1 << 20
MOD, LEFT_OUT = 5, 1


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: ASCII rules only


def _pack(a: np.ndarray, width: int = 4) -> bytes:
    """Numbers of ``width`` bytes as compressed byte planes: small numbers leave the high planes empty."""
    planes = np.ascontiguousarray(a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(b: bytes, width: int = 4) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<u{width}").ravel()


def _pack_shares(x: np.ndarray, width: int) -> bytes:
    """Rows of shares, their square roots in ``width`` bytes each (small shares keep their precision); zeros stay zeros."""
    total = x.sum(axis=1, keepdims=True)
    return _pack(np.rint((256**width - 1) * np.sqrt(x / np.where(total > 0, total, 1))).ravel(), width)


def _unpack_shares(b: bytes, states: int, width: int) -> np.ndarray:
    x = np.square(_unpack(b, width).reshape(-1, states).astype(np.float64))
    total = x.sum(axis=1, keepdims=True)
    return x / np.where(total > 0, total, 1)


def level(c: np.ndarray) -> np.ndarray:
    """0 for 0, 1 for 1, 2 for 2 and 3, 3 for 4 to 7, ..."""
    return np.frexp(c.astype(np.float64))[1]


def levels(min_count: int) -> int:
    """How many levels words without a profile of their own have; the end token's profile comes after them."""
    return (min_count - 1).bit_length() + 1


# ------------------------------------------------------------------ blocks and corpus counts
_BLOCK = "block long, ids array<{0}>, train binary, held binary, lens binary, toks binary, vocab array<binary>, n array<int>"


def _to_blocks(block_tokens: int):
    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text, train, held) -> a row per block of documents."""
        number = TaskContext.get().partitionId() << 32
        kind, ids, flags, docs, vocab, size = None, [], [], [], {}, 0

        def block():
            lens, toks = np.array([len(d) for d in docs], np.uint32), np.concatenate(docs)
            train, held = np.array(flags, bool).T
            order = np.argsort(-np.bincount(toks, minlength=len(vocab)), kind="stable")  # frequent words first
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            toks = rank[toks]
            n = np.bincount(toks[np.repeat(train, lens)], minlength=len(vocab))
            names = pa.array(list(vocab), pa.binary()).take(pa.array(order))
            lists = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
            row = [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(kind)),
                *(pa.array([x], pa.binary()) for x in (train.tobytes(), held.tobytes(), _pack(lens), _pack(toks))),
                lists(names),
                lists(pa.array(n.astype(np.int32))),
            ]
            return pa.RecordBatch.from_arrays(row, names=["block", "ids", "train", "held", "lens", "toks", "vocab", "n"])

        for b in batches:
            kind = b.schema.field(0).type
            for doc, text, train, held in zip(*b.columns):
                put = vocab.setdefault
                words = np.array([put(w, len(vocab)) for w in tokens(text.as_py())], np.uint32)
                ids.append(doc.as_py())
                flags.append((train.as_py(), held.as_py()))
                docs.append(words)
                size += len(words) + 1
                if size >= block_tokens:
                    yield block()
                    number, ids, flags, docs, vocab, size = number + 1, [], [], [], {}, 0
        if docs:
            yield block()

    return to_blocks


_SLOT = [("block", pa.int64()), ("part", pa.int32()), ("at", pa.binary()), ("c", pa.binary()), ("word", pa.binary()), ("seed", pa.binary()), ("v", pa.int64()), ("n", pa.int64())]
_SLOTS = "block long, part int, at binary, c binary, word binary, seed binary, v long, n long"


def _counted(min_count: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(vocab, block, at, n) sorted by vocab -> per block (at, c, word, seed): places, corpus counts and, for words with
        their own profile, 1 + number of the word in this part and a hash (else 0). Rows of block -1 have the part's totals."""
        part, own, known, total = TaskContext.get().partitionId(), 0, 0, 0
        rest, ready, waiting = None, [], 0

        def sums(t: pa.Table) -> None:
            """Complete words: their counts, for every row."""
            nonlocal own, known, total, waiting
            words = t.column("vocab").combine_chunks()
            new = np.append(True, pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)) if len(words) > 1 else np.ones(1, bool)
            run = np.cumsum(new) - 1
            c = np.bincount(run, t.column("n").to_numpy()).astype(np.int64)
            frequent = c >= min_count
            number = np.where(frequent, own + np.cumsum(frequent), 0)
            seed = np.zeros(len(c), np.int64)
            seed[frequent] = [crc32(w) for w in words.filter(pa.array(new)).filter(pa.array(frequent)).to_pylist()]
            own, known, total = own + int(frequent.sum()), known + int((c > 0).sum()), total + int(c.sum())
            ready.append((t.column("block").to_numpy(), t.column("at").to_numpy(), c[run], number[run], seed[run]))
            waiting += len(run)

        def sent() -> pa.RecordBatch:
            block, at, c, number, seed = map(np.concatenate, zip(*ready))
            order = np.lexsort((at, block))
            blocks, starts = np.unique(block[order], return_index=True)
            rows = [
                {"block": int(k), "part": part, "at": _pack(np.diff(at[r], prepend=0)), "c": _pack(c[r], 8), "word": _pack(number[r]), "seed": _pack(seed[r])}
                for k, r in zip(blocks, np.split(order, starts[1:]))
            ]
            return pa.RecordBatch.from_pylist(rows, pa.schema(_SLOT))

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            words = t.column("vocab").combine_chunks()
            cut = pc.index(pc.equal(words, words[-1]), True).as_py()  # the last word may go on
            rest = t.slice(cut)
            if cut:
                sums(t.slice(0, cut))
            if waiting >= FLUSH_ROWS:
                yield sent()
                ready, waiting = [], 0
        if rest is not None:
            sums(rest)
            yield sent()
            yield pa.RecordBatch.from_pylist([{"block": -1, "part": part, "v": known, "n": total}], pa.schema(_SLOT))

    return counted


_READY = "block long, ids array<{0}>, train binary, held binary, lens binary, toks binary, c binary, slots array<struct<part:int,at:binary,word:binary,seed:binary>>"


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their slots -> corpus counts in the order of the block's words, and where its words with a profile lie."""
    kind = pa.list_(pa.struct([("part", pa.int32()), ("at", pa.binary()), ("word", pa.binary()), ("seed", pa.binary())]))
    for b in batches:
        for r in range(b.num_rows):
            slots = b.column("slots")[r].as_py() or []
            at = [np.cumsum(_unpack(s["at"]).astype(np.int64)) for s in slots]
            c, own = np.zeros(sum(map(len, at)), np.int64), {}
            for s, a in zip(slots, at):
                c[a] = _unpack(s["c"], 8)
                word = _unpack(s["word"])
                if word.any():
                    own.setdefault(s["part"], []).append((a[word > 0], word[word > 0] - 1, _unpack(s["seed"])[word > 0]))
            found = []
            for p in sorted(own):
                a, word, seed = (np.concatenate(x) for x in zip(*own[p]))
                order = np.argsort(word)
                near = _pack(np.diff(word[order].astype(np.int64), prepend=0))
                found.append({"part": p, "at": _pack(a[order]), "word": near, "seed": _pack(seed[order])})
            one = b.slice(r, 1)
            cols = [one.column(k) for k in ("block", "ids", "train", "held", "lens", "toks")]
            cols += [pa.array([_pack(c, 8)], pa.binary()), pa.array([found], kind)]
            yield pa.RecordBatch.from_arrays(cols, names=["block", "ids", "train", "held", "lens", "toks", "c", "slots"])


# ------------------------------------------------------------------ the model
class Chain:
    """Start and moves of the hidden states; emissions are a row per word and a column per state."""

    def __init__(self, start: np.ndarray, move: np.ndarray):
        self.start, self.move = start, move

    @classmethod
    def initial(cls, states: int) -> Chain:
        move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move)

    @classmethod
    def estimate(cls, start: np.ndarray, move: np.ndarray) -> Chain:
        norm = lambda x: (x + 0.1) / (x + 0.1).sum(axis=-1, keepdims=True)
        return cls(norm(start), norm(move))

    def forward(self, emit: np.ndarray, seq: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """log10 likelihood of each sequence; ``seq`` holds them one after the other."""
        order = np.argsort(-lens, kind="stable")
        starts = (np.cumsum(lens) - lens)[order]
        active = np.searchsorted(-lens[order], -np.arange(int(lens.max(initial=0))), side="left")
        out, alpha = np.zeros(len(lens)), None
        for t, d in enumerate(active):
            e = emit[seq[starts[:d] + t]]
            alpha = (self.start * e) if t == 0 else (alpha[:d] @ self.move) * e
            s = alpha.sum(axis=1)
            alpha /= s[:, None]
            out[:d] += np.log10(s)
        back = np.empty_like(out)
        back[order] = out
        return back

    def expected(self, emit, seq, lens, group, groups, segment=SEGMENT, context=CONTEXT):
        """Baum-Welch counts of the sequences: start, moves, tokens by state and group of words, log10 likelihood.

        The recursions take the precision of ``emit``, the counts are added up in double precision."""
        k, kind = len(self.start), emit.dtype
        begins, moves = self.start.astype(kind), self.move.astype(kind)
        start, move, out, total = np.zeros(k), np.zeros((k, k)), np.zeros((k, groups)), 0.0
        begin, size, core, stop = pieces(lens, segment, context)
        order = np.argsort(-size, kind="stable")
        begin, size, core, stop = (x[order] for x in (begin, size, core, stop))
        at = 0
        while at < len(size):
            n = max(1, min(BATCH_TOKENS // int(size[at]), len(size) - at))
            part = slice(at, at + n)
            at += n
            b, z, lo, hi = begin[part], size[part], core[part], stop[part]
            steps = int(z[0])
            active = np.searchsorted(-z, -np.arange(steps), side="left")
            alphas, es, scales, words = [], [], [], []
            for t, d in enumerate(active):
                w = seq[b[:d] + t]
                e = emit[w]
                a = (begins * e) if t == 0 else (alphas[-1][:d] @ moves) * e
                s = a.sum(axis=1, keepdims=True)
                a /= s
                alphas.append(a)
                es.append(e)
                scales.append(s)
                words.append(w)
            beta, counted, posts = None, [], []
            for t in range(steps - 1, -1, -1):
                d, after = active[t], active[t + 1] if t + 1 < steps else 0
                now = np.ones((d, k), kind)
                if after:
                    f = es[t + 1] * beta[:after]
                    f /= scales[t + 1]
                    now[:after] = f @ moves.T
                    f *= ((t + 1 >= lo[:after]) & (t + 1 < hi[:after]))[:, None]  # moves into counted tokens
                    move += alphas[t][:after].T @ f
                beta = now
                inside = np.flatnonzero((t >= lo[:d]) & (t < hi[:d]))
                post = alphas[t][inside] * beta[inside]
                total += np.log10(scales[t][inside]).sum(dtype=np.float64)
                posts.append(post)
                counted.append(words[t][inside])
                if t == 0:
                    start += post[lo[inside] == 0].sum(axis=0, dtype=np.float64)
            flat, post = group[np.concatenate(counted)], np.concatenate(posts)
            for s in range(k):
                out[s] += np.bincount(flat, post[:, s], groups)
        return start, move * self.move, out, total


def pieces(lens: np.ndarray, segment: int, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin and length of the pieces that the sequences are trained in, and which of their tokens are counted."""
    context = max(1, context)
    many = -(-lens // segment)
    of = np.repeat(np.arange(len(lens)), many)
    k = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    first, last = k * segment, np.minimum((k + 1) * segment, lens[of])
    left, right = np.maximum(first - context, 0), np.minimum(last + context, lens[of])
    return (np.cumsum(lens) - lens)[of] + left, right - left, first - left, last - left


class Corpus:
    """What all blocks share: the chain, the states' shares, the levels' profiles, the end's count, corpus sizes."""

    def __init__(self, chain: Chain, share: np.ndarray, level_shares: np.ndarray, n: int, v: int, ends: int, min_count: int, width: int = 1):
        self.chain, self.share, self.level_shares = chain, share, level_shares
        self.n, self.v, self.ends, self.min_count, self.width = n, v, ends, min_count, width

    def emissions(self, shares: np.ndarray, c: np.ndarray) -> np.ndarray:
        """P(word | state) of words with these profiles (changed in place) and training counts; a row per word."""
        size, kind = self.n + 0.5 * (self.v + 1), shares.dtype
        shares *= c[:, None].astype(kind)
        shares += (0.5 * self.share).astype(kind)
        shares += (PRIOR * (c + 0.5) / size)[:, None].astype(kind)
        shares /= (self.share * size + PRIOR).astype(kind)
        return shares

    def block(self, row: dict, kind: type = np.float64) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[dict, np.ndarray]]]:
        """Emissions of a block's words and the end, their training counts, their groups and the places of its slots.

        Groups are the levels, the end and then the block's words with a profile of their own, slot by slot."""
        c, states = np.append(_unpack(row["c"], 8).astype(np.int64), self.ends), len(self.share)
        back = {s["part"]: s["x"] for s in row["back"] or ()}
        group = np.minimum(level(c), levels(self.min_count) - 1)
        group[-1] = levels(self.min_count)
        shares, places = [self.level_shares.astype(kind)], []
        count = len(self.level_shares)
        for s in row["slots"] or ():
            at = _unpack(s["at"]).astype(np.int64)
            group[at] = count + np.arange(len(at))
            count += len(at)
            places.append((s, at))
            if row["back"] is None:
                shares.append(first_shares(_unpack(s["seed"]).astype(np.uint64), states).astype(kind))
            else:
                shares.append(_unpack_shares(back[s["part"]], states, self.width).astype(kind))
        return self.emissions(np.concatenate(shares)[group], c), c, group, places


def first_shares(seed: np.ndarray, states: int) -> np.ndarray:
    """Profiles before training: random, the same for a word in every block."""
    z = seed[:, None] * np.uint64(0xD6E8FEB86659FD93) + np.arange(1, states + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
    r = 0.5 + (z ^ (z >> np.uint64(31))) / 2.0**64
    return r / r.sum(axis=1, keepdims=True)


def sequences(toks: np.ndarray, lens: np.ndarray, end: int) -> np.ndarray:
    """Word of every token, each document's end added."""
    out = np.full(len(toks) + len(lens), end, np.uint32)
    out[np.arange(len(toks)) + np.repeat(np.arange(len(lens)), lens)] = toks
    return out


# ------------------------------------------------------------------ passes over the blocks
def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[pa.RecordBatch, int, dict]]:
    for b in batches:
        for r in range(b.num_rows):  # one block at a time
            yield b, r, {k: b.column(k)[r].as_py() for k in names}


def _expect(shared, segment: int, context: int):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks -> per part the expected counts of its words; part -1 has start, moves, states, levels and likelihood."""
        schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("word", pa.binary()), ("n", pa.binary()), ("x", pa.binary()), ("totals", pa.list_(pa.float64()))])
        corpus, total = shared.value, 0
        few = len(corpus.level_shares)
        for _, _, row in _rows(batches, "block", "train", "lens", "toks", "c", "slots", "back"):
            lens, train = _unpack(row["lens"]).astype(np.int64), np.frombuffer(row["train"], bool)
            emit, c, group, places = corpus.block(row, np.float32)
            seq = sequences(_unpack(row["toks"]), lens, len(c) - 1)[np.repeat(train, lens + 1)]
            groups = few + sum(len(at) for _, at in places)
            counts = np.zeros((len(corpus.share), groups))  # a block without training texts asks for its words all the same
            if len(seq):
                start, move, counts, likelihood = corpus.chain.expected(emit, seq, lens[train] + 1, group, groups, segment, context)
                total = total + np.concatenate([start, move.ravel(), counts.sum(axis=1), counts[:, :few].ravel(), [likelihood]])
            first, out = few, []
            for s, at in places:
                x = counts[:, first : first + len(at)].T
                first += len(at)
                out.append({"part": s["part"], "block": row["block"], "word": s["word"], "n": _pack(np.rint(x.sum(axis=1))), "x": _pack_shares(x, corpus.width)})
            yield pa.RecordBatch.from_pylist(out, schema)
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_pylist([{"part": -1, "totals": total.tolist()}], schema)

    return expect


def _summed(states: int, width: int):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part, block, word, n, x) -> (block, part, x): the words' profiles over all blocks, for each block's words."""
        sums, asked = {}, []
        for b in batches:
            for part, block, word, n, x in zip(*(c.to_pylist() for c in b.columns)):
                at = np.cumsum(_unpack(word).astype(np.int64))
                have = sums.get(part, np.zeros((0, states)))
                if len(at) and at[-1] >= len(have):
                    have = np.vstack([have, np.zeros((max(at[-1] + 1 - len(have), len(have) // 2), states))])
                have[at] += _unpack_shares(x, states, width) * _unpack(n)[:, None]
                sums[part] = have
                asked.append((part, block, word))
        for part, block, word in asked:
            x = _pack_shares(sums[part][np.cumsum(_unpack(word).astype(np.int64))], width)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([x], pa.binary())], names=["block", "part", "x"]
            )

    return summed


def _score(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = shared.value
        n, v, ends = corpus.n, corpus.v, corpus.ends
        for b, r, row in _rows(batches, "held", "lens", "toks", "c", "slots", "back"):
            lens, toks = _unpack(row["lens"]).astype(np.int64), _unpack(row["toks"])
            emit, c, _, _ = corpus.block(row)
            doc = np.repeat(np.arange(len(lens)), lens)
            add = lambda x: np.bincount(doc, x[toks], len(lens))  # noqa: E731  sums by document
            base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
            cols = [
                b.column("ids")[r].values,
                pa.array(np.frombuffer(row["held"], bool)),
                pa.array(lens + 1),
                pa.array(add(c > 0).astype(np.int64) + (ends > 0)),
                pa.array(np.full(len(lens), n)),
                pa.array(add(base) + base[-1]),
                pa.array(corpus.chain.forward(emit, sequences(toks, lens, len(c) - 1), lens + 1)),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def _remove(df: DataFrame) -> None:
    """Remove the folder of a staged table that is not read again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
    min_count: int = MIN_COUNT,
    block_tokens: int = BLOCK_TOKENS,
    segment: int = SEGMENT,
    context: int = CONTEXT,
    share_bytes: int = 1,
    mod: int = MOD,
    left_out: int = LEFT_OUT,
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``share_bytes``: the precision in which profiles travel between tasks."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), in_training(id_col, mod, left_out).alias("train"),
        held_out(id_col, mod, left_out).alias("held"),
    )
    cut = stage(rows.mapInArrow(_to_blocks(block_tokens), _BLOCK.format(id_type)), "lm-blocks")
    n_blocks = max(1, cut.count())
    ends = rows.filter("train").count()

    # corpus counts
    words = cut.select("block", F.posexplode(F.arrays_zip("vocab", "n")).alias("at", "w")).select("w.vocab", "block", "at", "w.n")
    words = words.repartition("vocab").sortWithinPartitions("vocab")
    slots = stage(words.mapInArrow(_counted(min_count), _SLOTS), "lm-counts")
    known = slots.filter("block < 0").agg(F.sum("n"), F.sum("v")).first()
    n, v = (known[0] or 0) + ends, (known[1] or 0) + (ends > 0)

    # blocks with counts, bucketed: an iteration reads a block where its profiles arrive
    by_block = slots.filter("block >= 0").repartition(n_blocks, "block").groupBy("block").agg(
        F.collect_list(F.struct("part", "at", "c", "word", "seed")).alias("slots")
    )
    whole = cut.drop("vocab", "n").repartition(n_blocks, "block").join(by_block.hint("shuffle_hash"), "block", "left")
    name, path = f"lm_{uuid.uuid4().hex}", scratch_path(spark, "lm-ready")
    whole.mapInArrow(_assembled, _READY.format(id_type)).write.bucketBy(n_blocks, "block").option("path", path).saveAsTable(name)
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files lie in the scratch folder
    for used in (cut, slots):
        _remove(used)

    few = levels(min_count) + 1
    first = first_shares(np.arange(few, dtype=np.uint64), states)
    corpus = Corpus(Chain.initial(states), np.full(states, 1 / states), first, n, v, ends, min_count, share_bytes)
    sums, found, gained, before = None, None, None, None
    back_type = "array<struct<part:int,x:binary>>"

    def ready() -> DataFrame:
        """The blocks with the profiles of their words, null before the first iteration."""
        if sums is None:
            return blocks.withColumn("back", F.lit(None).cast(back_type))
        back = sums.repartition(n_blocks, "block").groupBy("block").agg(F.collect_list(F.struct("part", "x")).alias("back"))
        joined = blocks.join(back.hint("shuffle_hash"), "block", "left")
        return joined.withColumn("back", F.coalesce("back", F.array().cast(back_type)))

    for _ in range(iterations if ends else 0):
        shared, last = spark.sparkContext.broadcast(corpus), found
        found = stage(
            ready().drop("ids", "held").mapInArrow(
                _expect(shared, segment, context), "part int, block long, word binary, n binary, x binary, totals array<double>"
            ),
            "lm-expected",
        )
        every = found.filter("part < 0").select(F.posexplode("totals").alias("i", "x")).groupBy("i").agg(F.sum("x"))
        totals = np.array([x for _, x in sorted(every.collect())])  # one row per parameter
        start, move, tokens_in, by_level, likelihood = np.split(totals, np.cumsum([states, states**2, states, few * states]))
        by_level = by_level.reshape(states, few).T
        seen = by_level.sum(axis=1, keepdims=True)
        level_shares = np.where(seen > 0, by_level / np.where(seen > 0, seen, 1), 1 / states)
        chain = Chain.estimate(start, move.reshape(states, states))
        corpus = Corpus(chain, tokens_in / tokens_in.sum(), level_shares, n, v, ends, min_count, share_bytes)
        sums = found.filter("part >= 0").select("part", "block", "word", "n", "x").repartition("part")
        sums = sums.mapInArrow(_summed(states, share_bytes), "block long, part int, x binary")
        shared.unpersist()
        if last is not None:
            _remove(last)
        gained = None if before is None else (likelihood[0] - before) / n
        before = likelihood[0]
        if gained is not None and gained < tolerance:
            break

    shared = spark.sparkContext.broadcast(corpus)
    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return ready().mapInArrow(_score(shared), schema)
