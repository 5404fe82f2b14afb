"""Line quality by a linear-chain conditional random field, aggregated to documents.

Every line is good or bad. A line's features are bins of its shape (length, words, letters, symbols, repeats, ...)
and of the shapes of its two neighbours; the chain adds a weight for each pair of neighbouring labels. Forward and
backward sums give each line's probability of being good, and the document's is their mean weighted by line
length, mapped by a logistic curve to a calibrated probability.

``label_lines`` returns every line's probability and label, ``score_quality`` the documents' scores.

Labels exist for documents only, so a training document lends its label to all its lines. The field is fitted on
a sample of at most ``max_docs`` labelled documents, chosen by a hash of their id among those of at most
``max_chars`` characters (both parameters); only the binned features come to the driver. Scoring is one
pass over all whole texts without a shuffle; the fitted field has a fixed size.

Nulls and edge cases: a null or empty text is one empty line; without any training label every score is 1/2; an
id with contradicting or null labels trains nothing; of an id with several texts one trains, the same in every run;
null ids are scored and are not held out; repeated rows are scored each; other columns are ignored; an empty table
gives an empty result. Texts of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm._common import held_out, in_training

MAX_DOCS, MAX_CHARS = 3000, 100_000
MOD, LEFT_OUT, GOOD = 4, 2, 0.7

# byte classes: 0 lower-case or other letter, 1 upper, 2 digit, 3 space, 4 bar, 5 sentence mark, 6 other symbol, 7 newline
_CLASS = np.full(256, 6, np.uint8)
_CLASS[128:] = 0
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"|", b".,;:?'\"()-", b"", b"\n")):
    _CLASS[list(_chars)] = _k

# upper limits of the bins of each line feature
_BINS = [
    [1, 8, 20, 60, 150, 400, 1500],  # bytes
    [1, 2, 4, 8, 15, 40, 150],  # words
    [2, 3.5, 4.5, 5.5, 7, 9, 14],  # letters a word
    [0.01, 0.05, 0.15, 0.4, 0.8],  # upper-case share of letters
    [0.005, 0.03, 0.08, 0.15, 0.3, 0.6],  # symbols a byte
    [0.005, 0.03, 0.1, 0.3, 0.6],  # digits a byte
    [0.01, 0.05, 0.15, 0.4],  # bars a word
    [0.01, 0.04, 0.08, 0.15, 0.3],  # sentence marks a byte
    [0.01, 0.03, 0.08, 0.2, 0.5],  # words equal to the one before
    [0.15, 0.3, 0.5, 0.7, 0.85, 0.95],  # distinct words a word
]
_BINS = [np.array(b) for b in _BINS]
_WIDTH = np.array([len(b) + 1 for b in _BINS])
_FIRST = np.cumsum(_WIDTH) - _WIDTH
N_BINS = int(_WIDTH.sum())
#: a line's own bins, those of the line before and after, and a mark for a missing neighbour on either side
N_FEATURES = 3 * N_BINS + 2
_R = np.uint64(0x9E3779B97F4A7C15)


def line_bins(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bin numbers (lines x features) and the lines' lengths in bytes."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    kind = _CLASS[b]
    newline = kind == 7
    line = np.cumsum(newline) - newline
    n = int(newline.sum()) + 1
    count = np.bincount(line * 8 + kind, minlength=8 * n).reshape(n, 8).astype(np.float64)
    size = count[:, :7].sum(axis=1)
    # words: runs without space or newline
    in_word = (kind != 3) & ~newline
    starts = np.flatnonzero(in_word & np.append(True, ~in_word[:-1])) if len(b) else np.empty(0, np.int64)
    words = np.bincount(line[starts], minlength=n).astype(np.float64) if len(starts) else np.zeros(n)
    same, distinct = np.zeros(n), np.zeros(n)
    if len(starts):
        at = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))), axis=0) if starts[0] == 0 else None
        if at is None:
            at = np.arange(len(b)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(b)]])))
        mixed = (b.astype(np.uint64) + np.uint64(1)) * (at.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _R
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed[~in_word] = 0
        h = np.add.reduceat(mixed, starts)
        own = line[starts]
        again = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
        same = np.bincount(own[1:][again], minlength=n).astype(np.float64)
        order = np.lexsort((h, own))
        hs, os_ = h[order], own[order]
        new = np.append(True, (hs[1:] != hs[:-1]) | (os_[1:] != os_[:-1]))
        distinct = np.bincount(os_[new], minlength=n).astype(np.float64)
    letters, w, s = count[:, 0] + count[:, 1], np.maximum(words, 1), np.maximum(size, 1)
    values = [
        size, words, letters / w, count[:, 1] / np.maximum(letters, 1), count[:, 6] / s, count[:, 2] / s,
        count[:, 4] / w, count[:, 5] / s, same / w, np.where(words > 0, distinct / w, 1),
    ]
    bins = np.stack([np.searchsorted(lim, v, side="right") + f for lim, v, f in zip(_BINS, values, _FIRST)], axis=1)
    return bins.astype(np.uint8), size


def emissions(bins: np.ndarray, w: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Weight of 'good' against 'bad' for every line; documents follow one another from ``doc_starts`` on."""
    own, before, after = (w[k * N_BINS : (k + 1) * N_BINS][bins].sum(axis=1) for k in range(3))
    first = np.zeros(len(bins), bool)
    first[doc_starts] = True
    last = np.append(first[1:], True)
    prev = np.where(first, w[-2], np.append(0, before[:-1]))
    next_ = np.where(last, w[-1], np.append(after[1:], 0))
    return own + prev + next_


def marginals(e: np.ndarray, lens: np.ndarray, move: np.ndarray, pairs: bool = False):
    """P(good) of every line; with ``pairs`` also the expected number of each pair of neighbouring labels, and log Z."""
    order = np.argsort(-lens, kind="stable")
    starts = (np.cumsum(lens) - lens)[order]
    active = np.searchsorted(-lens[order], -np.arange(int(lens.max(initial=0))), side="left")
    psi = np.exp(np.stack([-e / 2, e / 2], axis=1).clip(-300, 300))
    step, alpha, scale = np.exp(move), [], []
    for t, d in enumerate(active):
        p = psi[starts[:d] + t]
        a = p if t == 0 else (alpha[-1][:d] @ step) * p
        s = a.sum(axis=1, keepdims=True)
        alpha.append(a / s)
        scale.append(s)
    good, seen, z = np.empty(len(e)), np.zeros((2, 2)), sum(float(np.log(s).sum()) for s in scale)
    beta = None
    for t in range(len(active) - 1, -1, -1):
        d, after = active[t], active[t + 1] if t + 1 < len(active) else 0
        b = np.ones((d, 2))
        if after:
            f = psi[starts[:after] + t + 1] * beta[:after] / scale[t + 1]
            if pairs:
                seen += (alpha[t][:after].T @ f) * step
            b[:after] = f @ step.T
        beta = b
        post = alpha[t] * b
        good[starts[:d] + t] = post[:, 1] / post.sum(axis=1)
    return (good, seen, z) if pairs else good


class Field:
    """Weights, label-pair weights and the calibration curve."""

    def __init__(self, w: np.ndarray, move: np.ndarray, slope: float = 1.0, shift: float = 0.0):
        self.w, self.move, self.slope, self.shift = w, move, slope, shift

    @classmethod
    def fit(cls, bins: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray, steps: int = 120) -> Field:
        """Maximum likelihood with a quadratic penalty, by gradient ascent with adaptive steps (Adam)."""
        w, move = np.zeros(N_FEATURES), np.zeros((2, 2))
        if not len(labels):
            return cls(w, move)
        lens = np.array([len(b) for b in bins])
        flat, starts = np.concatenate(bins).astype(np.int64), np.cumsum(lens) - lens
        y = np.repeat(labels, lens).astype(np.float64)
        stay = np.array([(lens[labels == k] - 1).sum() for k in (0, 1)], np.float64)
        first = np.zeros(len(flat), bool)
        first[starts] = True
        last = np.append(first[1:], True)
        theta = np.zeros(N_FEATURES + 4)
        m, v, n = np.zeros_like(theta), np.zeros_like(theta), len(flat)
        for k in range(1, steps + 1):
            w, move = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
            good, seen, _ = marginals(emissions(flat, w, starts), lens, move, pairs=True)
            r = y - good
            grad = np.zeros_like(theta)
            for j, (rows, shift) in enumerate(((slice(None), 0), (~first, -1), (~last, 1))):
                at = np.flatnonzero(np.ones(n, bool)[rows] if j == 0 else rows)
                for f in range(flat.shape[1]):
                    grad[j * N_BINS : (j + 1) * N_BINS] += np.bincount(flat[at + shift, f], r[at], N_BINS)
            grad[N_FEATURES - 2], grad[N_FEATURES - 1] = r[first].sum(), r[last].sum()
            grad[N_FEATURES:] = (np.diag(stay) - seen).ravel()
            grad = grad / len(labels) - 1e-3 * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta = theta + 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        out = cls(theta[:N_FEATURES].copy(), theta[N_FEATURES:].reshape(2, 2).copy())
        out.calibrate(out.quality(bins, sizes), labels)
        return out

    def calibrate(self, x: np.ndarray, labels: np.ndarray) -> None:
        """Logistic curve from mean line quality (as log odds) to the label, by Newton's method; targets are smoothed."""
        x, n1 = _logit(x), labels.sum()
        y = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (len(labels) - n1 + 2))
        a = np.array([0.1, 0.0])
        for _ in range(60):
            p = 1 / (1 + np.exp(-(a[0] * x + a[1]).clip(-30, 30)))
            q = p * (1 - p) + 1e-9
            g = np.array([((y - p) * x).sum() - 1e-2 * a[0], (y - p).sum()])
            h = np.array([[(q * x * x).sum() + 1e-2, (q * x).sum()], [(q * x).sum(), q.sum() + 1e-6]])
            a = a + np.linalg.solve(h, g).clip(-1, 1)
        self.slope, self.shift = float(max(a[0], 1e-3)), float(a[1])

    def lines(self, bins: list[np.ndarray]) -> np.ndarray:
        """P(good) of every line of the documents."""
        lens = np.array([len(b) for b in bins])
        starts = np.cumsum(lens) - lens
        return marginals(emissions(np.concatenate(bins).astype(np.int64), self.w, starts), lens, self.move)

    def quality(self, bins: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """Mean P(good) of the documents' lines, weighted by length."""
        lens = np.array([len(b) for b in bins])
        starts, good = np.cumsum(lens) - lens, self.lines(bins)
        weight = np.concatenate(sizes) + 1
        return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        bins, sizes = zip(*map(line_bins, texts))
        x = _logit(self.quality(list(bins), list(sizes)))
        return 1 / (1 + np.exp(-(self.slope * x + self.shift).clip(-30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = p.clip(1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_field(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_docs: int = MAX_DOCS,
    max_chars: int = MAX_CHARS,
) -> Field:
    """Fit on at most ``max_docs`` documents; ids whose crc32 modulo 4 is 2 are left out."""
    known = (
        labels.filter(in_training(id_col, MOD, LEFT_OUT))
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.min(label_col).alias("y"), F.max(label_col).alias("other"))
        .filter("y = other AND y IN (0, 1)")
        .orderBy(F.xxhash64("label_id"))
        .select("label_id", "y")
        .limit(max_docs)
    )
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(
        F.char_length(F.coalesce("text", F.lit(""))) <= max_chars
    )
    # at most max_docs rows are broadcast; an id may repeat in the documents
    chosen = chosen.join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select("doc_id", "y", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [line_bins(t) for t in b.column(2).to_pylist()]
            cols = [b.column(0), b.column(1), *(pa.array([x.tobytes() for x in c], pa.binary()) for c in zip(*got))]
            if got:
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "y", "bins", "sizes"])

    id_type = docs.schema[id_col].dataType.simpleString()
    described = chosen.mapInArrow(describe, f"doc_id {id_type}, y int, bins binary, sizes binary")
    # one text of each id, the same in every run: at most max_docs rows
    one = described.groupBy("doc_id").agg(F.min(F.struct("bins", "sizes", "y")).alias("row"))
    rows = [r.row for r in sorted(one.collect(), key=lambda r: r.doc_id)]
    bins = [np.frombuffer(r.bins, np.uint8).reshape(-1, len(_BINS)) for r in rows]
    return Field.fit(bins, [np.frombuffer(r.sizes, np.float64) for r in rows], np.array([r.y for r in rows], np.int64))


def score_quality(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col, MOD, LEFT_OUT).alias("h"), F.col(text_col).alias("t"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                s = field.score(part.column(2).to_pylist())
                cols = [part.column(0), part.column(1), pa.array(s), pa.array((s >= GOOD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def label_lines(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per line (texts are cut at line feeds): doc_id, line (from 0), p_good and the label, good."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                bins = [line_bins(t)[0] for t in part.column(1).to_pylist()]
                lens = np.array([len(x) for x in bins])
                p = field.lines(bins)
                ids = part.column(0).take(pa.array(np.repeat(np.arange(len(lens)), lens)))
                line = np.arange(len(p)) - np.repeat(np.cumsum(lens) - lens, lens)
                yield pa.RecordBatch.from_arrays([ids, pa.array(line), pa.array(p), pa.array(p >= 0.5)], names=["doc_id", "line", "p_good", "good"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(label, f"doc_id {id_type}, line long, p_good double, good boolean")


def keep_good(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The documents with a score of ``GOOD`` or more, all columns unchanged."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                yield part.filter(pa.array(field.score(part.column(at).to_pylist()) >= GOOD))

    return docs.mapInArrow(keep, docs.schema)
