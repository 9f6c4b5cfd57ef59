"""Token counts by overlap resynchronisation.

A text is encoded by the tokenizer's library. A huge one is encoded in overlapping chunks with offsets
and the encodings are spliced at a proven stable common boundary: both chunks begin a token
there, the byte before is no space and the one there is a space, the next tokens agree, and no
piece of the vocabulary holds a space behind anything else, so that no merge can cross the place
in the whole text either. If an overlap has no such place, it is widened, to the end of the text if
need be. A chunk is all that is held encoded with offsets, however long the text.

Null texts count as empty (no bytes, no tokens). Rows are judged one by one, so repeated rows
repeat, an empty table gives an empty result, and columns that clash with appended ones give way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortwatch.llm import _spark

#: Bytes beyond which a text is encoded in chunks, bytes of a chunk, and of the first overlap.
HUGE, CHUNK, OVERLAP = 1 << 14, 1 << 13, 1 << 9
#: Tokens that must agree from a splice on (fewer only where a chunk ends).
AGREE = 4
SPACE, MARK = 0x20, "▁"


class Counter:
    """Counts tokens of texts with a SentencePiece model, whole or spliced."""

    def __init__(self, model: str, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.huge, self.chunk, self.overlap = huge, chunk, overlap
        pieces = (self.model.id_to_piece(k) for k in range(self.model.get_piece_size()))
        #: Whether a space can only begin a piece (or be one): else nothing is proven and texts are encoded whole.
        self.proven = not any(MARK in p.lstrip(MARK) for p in pieces)

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text, without any added ones."""
        out, plain, at, size = [0] * len(texts), [], [], 0
        for k, text in enumerate(texts):
            if self.proven and len(text) * 4 > self.huge and len(data := text.encode()) > self.huge:
                out[k] = self.spliced(data)
                continue
            plain.append(text)
            at.append(k)
            size += len(text)
            if size > 1 << 20:
                self._whole(plain, at, out)
                plain, at, size = [], [], 0
        self._whole(plain, at, out)
        return out

    def _whole(self, texts: list[str], at: list[int], out: list[int]) -> None:
        for k, ids in zip(at, self.model.encode(texts, num_threads=1) if texts else []):
            out[k] = len(ids)

    def _encode(self, data: bytes, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin (in the whole text) and id of each token of one chunk."""
        pieces = self.model.encode(data[start:end].decode(), return_type="proto").pieces
        return np.array([start + p.begin for p in pieces], np.int64), np.array([p.id for p in pieces], np.int64)

    def _splice(self, data: bytes, left: tuple, right: tuple, start: int, end: int) -> int | None:
        """The first stable common boundary of two encodings between ``start`` and ``end``."""
        bytes_ = np.frombuffer(data, np.uint8)
        common = np.intersect1d(left[0], right[0])
        common = common[(common > start + 1) & (common < end)]
        for p in common[(bytes_[common] == SPACE) & (bytes_[common - 1] != SPACE)]:
            if data[max(0, p - 3) : p] == MARK.encode():
                continue
            i, j = int(np.searchsorted(left[0], p)), int(np.searchsorted(right[0], p))
            n = min(AGREE, len(left[0]) - i - 1, len(right[0]) - j - 1)  # a chunk's last token may be cut short
            if n > 0 and (left[1][i : i + n] == right[1][j : j + n]).all() and (left[0][i : i + n] == right[0][j : j + n]).all():
                return int(p)
        return None

    def spliced(self, data: bytes) -> int:
        """The number of tokens of one text, from overlapping chunks."""

        def floor(p: int) -> int:  # to the start of a character
            while 0 < p < len(data) and data[p] & 0xC0 == 0x80:
                p -= 1
            return min(p, len(data))

        total, begin, done, end = 0, 0, 0, floor(self.chunk)
        left = self._encode(data, begin, end)
        while end < len(data):
            overlap, at = self.overlap, None
            while True:
                start = max(done, floor(end - overlap))
                next_end = floor(max(end, start + self.chunk))
                right = self._encode(data, start, next_end)
                at = self._splice(data, left, right, start, end) if start > begin else None
                if at is not None:
                    break
                if start <= max(done, begin):  # the overlap is all of the chunk: make that longer
                    end = floor(begin + 2 * (end - begin))
                    left = self._encode(data, begin, end)
                    if end >= len(data):
                        return total + int((left[0] >= done).sum()) if done else len(left[0])
                    overlap = self.overlap
                else:
                    overlap *= 2
            total += int(np.searchsorted(left[0], at) - (np.searchsorted(left[0], done) if done else 0))
            left, begin, done, end = right, start, at, next_end
        return total + len(left[0]) - (int(np.searchsorted(left[0], done)) if done else 0)


def count_tokens(docs: DataFrame, model: str, text_col: str = "text", limit: int = 4096, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) appended.

    ``model`` is the path of a SentencePiece model that every executor can read.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    own = [c for c in docs.columns if c.lower() not in added]
    text_at = len(own)

    def run(batches):
        counter = Counter(model, huge, chunk, overlap)
        for batch in batches:
            n = counter.count([x or "" for x in batch.column(text_at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:text_at], pa.array(n, pa.int64())], names=[*own, "n_tokens"])

    text = F.col(f"`{text_col}`").cast("string")
    whole = _spark.free_name(docs, "whole_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias(whole))
    own = [*own, "n_bytes"]
    text_at += 1
    schema = StructType(rows.schema.fields[:text_at]).add("n_tokens", "long")
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
