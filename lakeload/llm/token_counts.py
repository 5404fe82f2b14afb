"""Token counts of whole texts by a SentencePiece vocabulary: batches of even bytes, long texts cut at safe places.

An Arrow function receives the texts and returns lengths only; no token id leaves the worker. Texts are gathered
into batches of about ``BATCH_BYTES`` bytes, whatever the number of texts, and encoded a batch at a time, so that the
memory of a worker depends neither on the number of rows nor on the length of a text.

Safe places. Merging never joins two characters that stand next to each other in no piece of the vocabulary, so a
text cut between them has the tokens of its two sides. The set of neighbouring characters of all pieces is made from
the vocabulary once per worker. The library puts a space before every text it encodes; a side that begins in mid-text
is therefore given a line feed in front, which is in no piece of several characters, and the tokens of a line feed alone are taken
off again. A text without a safe place (one run of a repeated letter) is encoded whole. Where the vocabulary changes
texts before it cuts them (its normaliser is not the identity), or where its pieces hold line feeds, every text is
encoded whole.

Nulls and edge cases: a null or empty text has no bytes and no tokens; null ids are kept; every repeated row gets its
own count; ties do not arise; other columns are ignored; an empty table gives no rows. Texts of any length are counted
whole, without truncation; the strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 4096
PIECE_CHARS = 8192  # a text is cut at the first safe place after so many characters
BATCH_BYTES = 1 << 20
_SPACE, _LEAD = "▁", "\n"  # the sign for a space inside pieces; what stands before a side that begins in mid-text


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCounter:
    """Counts tokens with one SentencePiece vocabulary."""

    _of: dict[str, PieceCounter] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [p for p in map(self.model.id_to_piece, range(self.model.vocab_size())) if len(p) > 1]
        self.inside = {p[k : k + 2] for p in pieces for k in range(len(p) - 1)}
        probe = "ﬁ ①  x　\xa0é "
        self.cuts = (
            self.model.normalize(probe) == _SPACE + probe.replace(" ", _SPACE)
            and not any(_LEAD in pair for pair in self.inside)
        )
        self.lead = len(self.model.encode(_LEAD))

    @classmethod
    def of(cls, path: str | None) -> PieceCounter:
        """One per Python worker and path."""
        path = path or default_model()
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def split(self, text: str, size: int) -> list[str]:
        """The text in sides of about ``size`` characters whose token counts add up to the text's."""
        if len(text) <= size or not self.cuts:
            return [text]
        out, start, at, inside = [], 0, size, self.inside
        while at < len(text):
            if text[at - 1 : at + 1].replace(" ", _SPACE) in inside:
                at += 1
                continue
            out.append(text[start:at])
            start, at = at, at + size
        return [*out, text[start:]]

    def encode_lengths(self, sides: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(sides, out_type=int, num_threads=1)]


def _count(path: str | None, piece_chars: int, batch_bytes: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text) -> (doc_id, n_bytes, n_tokens)"""
        counter = None
        for b in batches:
            counter = counter or PieceCounter.of(path)
            texts = pc.fill_null(b.column(1), "")
            n_tokens = np.zeros(b.num_rows, np.int64)
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            sides, owner, waiting = [], [], 0

            def flush(n_tokens=n_tokens):
                np.add.at(n_tokens, owner, counter.encode_lengths(sides))
                sides.clear()
                owner.clear()

            for row, text in enumerate(texts):
                for k, side in enumerate(counter.split(text.as_py(), piece_chars)):
                    sides.append(_LEAD + side if k else side)
                    owner.append(row)
                    n_tokens[row] -= counter.lead if k else 0
                    waiting += len(side.encode()) if len(side) > 1 else 1
                    if waiting >= batch_bytes:
                        flush()
                        waiting = 0
            flush()
            yield pa.RecordBatch.from_arrays([b.column(0), n_bytes, pa.array(n_tokens)], names=["doc_id", "n_bytes", "n_tokens"])

    return count


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str | None = None,
    limit: int = LIMIT,
    piece_chars: int = PIECE_CHARS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit. ``model`` is a path that every executor can read."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(
        _count(model, piece_chars, batch_bytes), f"doc_id {id_type}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
