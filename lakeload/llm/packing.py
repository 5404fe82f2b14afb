"""Packing of tokenised documents into fixed windows by the sum-of-squares rule.

Every task packs the documents of its own input split as they stream by. A level array holds, for each fill
level, how many windows are open there; a document (or the rest of one longer than a window) goes to the level
for which the sum of the squared counts is smallest afterwards. That needs no look-ahead, no shuffle and no
state that grows with the input: open windows hold at most ``max_open`` windows' ids. When more are open, or at
the end of a split, fuller windows are topped up with pieces cut off the emptier ones. What is left at the end
of a split (under one window) is cut at powers of two, which need no padding.

Nulls and edge cases: a null or empty text is the end token alone; a null id is kept; repeated rows are packed
once per row; an empty table gives no rows; other columns are ignored. Texts of any length are packed whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CAPACITY, END_ID = 4096, 2
CHUNK = 2 << 20  # characters (or the 64 texts that pass it) whose words are looked up together, each once
# A Python worker remembers the ids of about as many pieces, and of so many bytes of them and their ids.
# Workers stay for the stages that follow, so this is memory that an executor has less for them: about 60 MB each.
CACHE_WORDS, CACHE_BYTES = 400_000, 32 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The vocabulary merges within words only, so Arrow splits texts into words and each different one is looked up once. Words
    are cut as the tokenizer's own pattern cuts them, and the pieces not met yet are encoded by ``tokenizers`` in
    batches. Texts outside plain Latin-1, where normalisation could cross word borders, and texts with the special
    tokens' strings go through ``tokenizers`` whole.
    """

    _of: dict[str, WordTokenizer] = {}
    _plain = re.compile("[\t-\r -~\xa1-\xac\xae-\xff]*")
    # fixed values: the pattern of the vocabulary file, for lower-case Latin-1
    _letters, _numbers = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
    _piece = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_letters}]+|[{_numbers}]|[^ \t-\r{_letters}{_numbers}]+")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole, self.pieces = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        by_byte = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), by_byte])
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = token.endswith("</w>")  # the last id of a piece
        self.cache: dict[str, bytes] = {}
        self.held = 0  # bytes of the pieces and ids in it

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """One per Python worker and path, so its cache serves every task of the worker."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of different words, by their pieces: all ids in one array, where each word's begin and how many it has."""
        cache = self.cache
        cut = list(map(self._piece.findall, "\n".join(words).lower().split("\n")))
        pieces = list(set().union(*cut).difference(cache))
        parts = [pieces[k : k + 100] for k in range(0, len(pieces), 100)]
        for part, e in zip(parts, self.pieces.encode_batch_fast([" ".join(x) for x in parts], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            cache.update(zip(part, [raw[p:q] for p, q in zip([0, *ends], ends)]))
            self.held += sum(map(len, part)) + len(raw)
        coded = list(map(cache.__getitem__, chain.from_iterable(cut)))
        ends = np.cumsum([0, *map(len, coded)], dtype=np.int64)[np.cumsum([0, *map(len, cut)])] // 4
        return np.frombuffer(b"".join(coded), "<u4"), ends[:-1], np.diff(ends)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.cache) > CACHE_WORDS or self.held > CACHE_BYTES:
            self.cache.clear()
            self.held = 0
        plain = [bool(t and self._plain.fullmatch(t) and not any(s in t for s in self.special)) for t in texts]
        words = pc.ascii_split_whitespace(pa.array([t for t, p in zip(texts, plain) if p], pa.large_string()))
        coded = words.flatten().dictionary_encode()
        ids, begin, size = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        of = coded.indices.to_numpy()
        sizes = size[of]
        upto = np.cumsum(np.concatenate([[0], sizes]))  # ids before each word
        ids = ids[np.repeat(begin[of] - upto[:-1], sizes) + np.arange(upto[-1])]
        ends = iter(upto[np.cumsum(pc.list_value_length(words).to_numpy())].tolist())
        found, at = [], 0
        for t, p in zip(texts, plain):
            if p:
                start, at = at, next(ends)
                found.append(ids[start:at].tobytes())
            else:
                whole = self.whole.encode(t, add_special_tokens=False).ids if t else []
                found.append(np.array(whole, "<u4").tobytes())
        return found


class Packer:
    """Sum-of-squares packing of one stream. A piece is [doc, start, ids as bytes, the document's tokens]."""

    def __init__(self, capacity: int, first_id: int, max_open: int):
        self.c, self.next_id, self.max_open = capacity, first_id, max_open
        self.level = np.zeros(capacity + 1, np.int64)  # open windows at each fill level
        self.open: dict[int, list[list]] = {}  # level -> windows, each a list of pieces
        self.n_open, self.out = 0, []

    def add(self, doc, ids: bytes) -> None:
        n, c = len(ids) // 4, self.c
        whole = n - n % c
        for s in range(0, whole, c):
            self._close([[doc, s, ids[4 * s : 4 * (s + c)], n]])
        if n > whole:
            self._place([doc, whole, ids[4 * whole :], n], n - whole)

    def _place(self, piece: list, size: int) -> None:
        c, n = self.c, self.level
        # change of the sum of squares: 2n+1 where the window arrives, 1-2n where it leaves
        cost = 2 * n[size : c + 1] + 1
        cost[c - size] = 0  # a full window is closed and no longer counted
        cost[1:] += 1 - 2 * n[1 : c - size + 1]
        cost[1:][n[1 : c - size + 1] == 0] = np.iinfo(np.int64).max
        h = c - size - int(np.argmin(cost[::-1]))  # of equals the fullest
        if h:
            window = self.open[h].pop()
            n[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if h + size == c:
            self._close(window)
        else:
            self._keep(window, h + size)
        if self.n_open > self.max_open:
            self._top_up()

    def _keep(self, window: list, size: int) -> None:
        self.open.setdefault(size, []).append(window)
        self.level[size] += 1
        self.n_open += 1

    def _top_up(self) -> None:
        """Fill the fuller windows with pieces cut off the emptier ones; at most one stays open."""
        windows = [(h, w) for h in sorted(self.open) for w in self.open[h]]
        self.open, self.n_open = {}, 0
        self.level[:] = 0
        lo, hi, loose = 0, len(windows) - 1, []
        while lo <= hi:
            size, window = windows[hi]
            hi -= 1
            while size < self.c and (loose or lo <= hi):
                if not loose:
                    loose = windows[lo][1]
                    lo += 1
                doc, start, ids, n = loose.pop()
                k = min(len(ids) // 4, self.c - size)
                window.append([doc, start, ids[: 4 * k], n])
                if 4 * k < len(ids):
                    loose.append([doc, start + k, ids[4 * k :], n])
                size += k
            if size == self.c:
                self._close(window)
            else:
                self._keep(window, size)
        if loose:
            self._keep(loose, sum(len(p[2]) // 4 for p in loose))

    def _close(self, window: list) -> None:
        seq, at = self.next_id, 0
        self.next_id += 1
        for doc, start, ids, n in window:
            k = len(ids) // 4
            self.out.append((doc, start, k, crc32(ids), n, seq, at))
            at += k

    def finish(self) -> None:
        while self.n_open > 1:
            self._top_up()
        for size, windows in [(h, w) for h, w in self.open.items() if w]:
            pieces = windows[0][::-1]
            while size:  # the rest as powers of two, largest first
                room, window = 1 << (size.bit_length() - 1), []
                size -= room
                while room:
                    doc, start, ids, n = pieces.pop()
                    k = min(len(ids) // 4, room)
                    window.append([doc, start, ids[: 4 * k], n])
                    if 4 * k < len(ids):
                        pieces.append([doc, start + k, ids[4 * k :], n])
                    room -= k
                self._close(window)
        self.open, self.n_open = {}, 0


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    max_open: int = 1024,
) -> DataFrame:
    """One row per piece: where its document's ids lie. ``sequence_id`` is the split's number and a running one."""
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, TaskContext.get().partitionId() << 32, max_open)
        tok, kinds = WordTokenizer.of(path), None

        def drain():
            rows, packer.out = packer.out, []
            cols = list(zip(*rows)) if rows else [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kinds), *(pa.array(c, pa.int64()) for c in cols[1:])], names=schema.fieldNames()
            )

        docs, texts, size = [], [], 0

        def place():
            for doc, ids in zip(docs, tok.encode(texts)):
                packer.add(doc, ids + end)
            docs.clear()
            texts.clear()

        for b in batches:
            kinds = b.schema.field(0).type
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                docs += part.column(0).to_pylist()
                texts += part.column(1).to_pylist()
                size += sum(len(t) for t in texts[-part.num_rows :] if t)
                if size >= CHUNK:
                    place()
                    size = 0
            if len(packer.out) >= 5000:
                yield drain()
        if kinds is not None:
            place()
            packer.finish()
            yield drain()

    return docs.select(id_col, text_col).mapInArrow(pack, schema)
