"""Token ids in files: frequency-ranked ids in byte-aligned variable-length code with separate control bytes.

The ids of all documents are ranked by how often they occur, so frequent ones are small numbers. A
rank takes one to four bytes; two bits a rank in a control stream of its own tell which, four to a
control byte. Blocks of whole documents hold document ids, id counts, control bytes and data bytes;
the ranks' ids are a table beside them. Decoding looks control bytes up in tables with numpy.

A folder holds ``ranks`` (rank, id) and ``blocks`` (part, block, before, doc_ids, counts, control,
data; ``before`` is the number of ids before it in its part), the parts in ascending id order, written by Spark's committed Parquet writer, so any store that Spark
reaches will do and a lost executor's blocks are written again.

Documents stand in ascending id order, null ids first, ties by text; null texts are empty
documents (their end id only). An empty table gives files without blocks.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.llm import _spark, _text

BLOCK_IDS = 1 << 20
#: Distinct words whose ids a Python worker remembers, and the places of its hash table.
KNOWN_WORDS, PLACES = 1_500_000, 1 << 22
#: Words that are looked up at once; fewer than are remembered.
SLICE = 1 << 20
#: New words that the library is given as one text.
JOINED = 2000

_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_BYTES = _LENGTHS.sum(1).astype(np.int64)
_STARTS = np.cumsum(_LENGTHS, 1).astype(np.int64) - _LENGTHS
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = values.astype("<u4")
    length = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = length - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that :func:`pack` was given, by table lookup of the control bytes."""
    codes = np.frombuffer(control, np.uint8)
    size = _BYTES[codes]
    start = np.cumsum(size) - size
    at = (start[:, None] + _STARTS[codes]).reshape(-1)[:n]
    length = _LENGTHS[codes].reshape(-1)[:n]
    padded = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.uint32)
    return (padded[at] | padded[at + 1] << 8 | padded[at + 2] << 16 | padded[at + 3] << 24) & _MASKS[length]


class Encoder:
    """Ids of whole texts from a ``tokenizers`` file.

    The library encodes each distinct word between ASCII white space once; that is exact where the
    file's pre-tokenizer drops white space, which is looked up, and else texts are encoded whole.
    Words are told apart by a 64-bit hash.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        # Text between special tokens is encoded as if it stood alone, so one of them can part words.
        marks = [t for t in config.get("added_tokens", []) if t["special"] and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"])]
        self.mark, self.mark_id = (marks[0]["content"], marks[0]["id"]) if marks else (None, None)
        self.by_word = bool(marks) and self._splits_at_space(config)
        self._forget()

    @staticmethod
    def _splits_at_space(config: dict) -> bool:
        pre = config.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        normalizers = (config.get("normalizer") or {}).get("normalizers") or [config.get("normalizer") or {}]
        drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and "[^\\s" in first.get("pattern", {}).get("Regex", "")
        local = all(n.get("type") in ("NFC", "Lowercase") or n.get("type") == "Replace" and n.get("pattern") == {"Regex": "\\s+"} for n in normalizers)
        plain = not any(" " in t["content"] or t["single_word"] for t in config.get("added_tokens", []))
        return bool(drops and local and plain and not config.get("post_processor"))

    def _forget(self) -> None:
        self.places, self.index, self.n = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.int32), 0
        self.flat, self.offsets = np.zeros(1 << 16, np.uint32), np.zeros(KNOWN_WORDS + 2, np.int64)

    def _find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word hash (not 0) its place in the table, or the free one it would get, and whether it is there."""
        place = (words >> np.uint64(42)).astype(np.int64)
        held = self.places[place]
        off = np.flatnonzero((held != words) & (held != 0))
        while len(off):
            place[off] = (place[off] + 1) & (PLACES - 1)
            held[off] = self.places[place[off]]
            off = off[(held[off] != words[off]) & (held[off] != 0)]
        return place, held != 0

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        ids, sizes = [], []
        for k in range(0, len(words), JOINED):
            own = words[k : k + JOINED]
            joined = self.mark.join(own)
            if joined.count(self.mark) == len(own) - 1:
                found = np.array(self.library.encode(joined, add_special_tokens=False).ids, np.uint32)
                at = np.flatnonzero(found == self.mark_id)
                sizes.append(np.diff(np.concatenate([[-1], at, [len(found)]])) - 1)
                ids.append(np.delete(found, at))
            else:  # some word has the mark in it
                each = [e.ids for e in self.library.encode_batch_fast(own, add_special_tokens=False)]
                sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
                ids.append(np.fromiter((i for x in each for i in x), np.uint32))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Encode words that are new and different."""
        ids, size = self._encode_words(words)
        used = int(self.offsets[self.n])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[used : used + len(ids)] = ids
        self.offsets[self.n + 1 : self.n + 1 + len(words)] = used + np.cumsum(size)
        number = np.arange(self.n, self.n + len(words), dtype=np.int32)
        self.n += len(words)
        while len(hashes):  # of words that want the same free place one gets it, the others look on
            place, _ = self._find(hashes)
            _, first = np.unique(place, return_index=True)
            self.places[place[first]], self.index[place[first]] = hashes[first], number[first]
            rest = np.ones(len(hashes), bool)
            rest[first] = False
            hashes, number = hashes[rest], number[rest]

    def encode(self, texts) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each chunk of a string column its ids and where each document's begin (and the last end)."""
        return [self._chunk(c) for c in _text.chunks(texts)]

    def _chunk(self, chunk: _text.Chunk) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            texts = [bytes(chunk.data[a:b]).decode() for a, b in zip(chunk.offsets, chunk.offsets[1:])]
            ids = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for x in ids for i in x], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        starts, ends, first = chunk.spans(_text.NOT_SPACE)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(chunk.n_docs + 1, np.int64)
        hashes = chunk.hashes(starts, ends, _text.AS_IS) | np.uint64(1)
        parts = [self._words(chunk, hashes[k : k + SLICE], starts[k : k + SLICE], ends[k : k + SLICE]) for k in range(0, len(hashes), SLICE)]
        to = np.cumsum(np.concatenate([n for _, n in parts]))
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([[0], to])[first]

    def _words(self, chunk: _text.Chunk, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words in a row, and how many each has."""
        place, there = self._find(hashes)
        if not there.all():
            if self.n + np.count_nonzero(~there) > KNOWN_WORDS:
                self._forget()
                there[:] = False
            new = np.flatnonzero(~there)
            distinct, at = np.unique(hashes[new], return_index=True)
            at = new[at]
            self._learn(distinct, [chunk.data[a:b].tobytes().decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            place, _ = self._find(hashes)
        index = self.index[place].astype(np.int64)
        size = self.offsets[index + 1] - self.offsets[index]
        to = np.cumsum(size)
        return self.flat[np.arange(to[-1]) + np.repeat(self.offsets[index] - (to - size), size)], size


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A worker's encoder of that file: made once, with the words it has met."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_BLOCK = "part int, block int, before long, doc_ids array<long>, counts array<int>, control binary, data binary"
_NAMES = ["part", "block", "before", "doc_ids", "counts", "control", "data"]


def _block(part: int, block: int, before: int, docs: list, counts: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
    """A block in the making: ranks of its own, which ``known`` translates."""
    ids = np.concatenate(held)
    known, index, n = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(known), np.uint32)
    rank[order] = np.arange(len(known))
    control, data = pack(rank[index])
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int32())), pa.array([control]), pa.array([data]), pa.array([known[order].tobytes()])], [*_NAMES, "known"])


def _encoded(path: str, end_id: int):
    """Blocks with ranks of their own, and at the end of a part a row (block -1) with its ids' counts."""

    def run(batches):
        part, block, before, size = TaskContext.get().partitionId(), 0, 0, 0
        held: list[np.ndarray] = []
        docs: list = []
        counts: list[int] = []
        end, total = np.array([end_id], np.uint32), np.zeros(1, np.int64)
        for batch in batches:
            at = 0
            for ids, first in encoder(path).encode(batch.column("text")):
                new = np.bincount(ids, minlength=max(len(total), end_id + 1))
                new[end_id] += len(first) - 1
                new[: len(total)] += total
                total, n = new, len(first) - 1
                own = batch.column("doc_id").slice(at, n).to_pylist()
                at += n
                for d in range(n):
                    held += [ids[first[d] : first[d + 1]], end]
                    docs.append(own[d])
                    counts.append(int(first[d + 1] - first[d]) + 1)
                    size += counts[-1]
                    if size >= BLOCK_IDS:
                        yield _block(part, block, before, docs, counts, held)
                        block, before, size, held, docs, counts = block + 1, before + size, 0, [], [], []
        if docs:
            yield _block(part, block, before, docs, counts, held)
        known = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([-1], pa.int32()), pa.array([0], pa.int64()), pa.array([known.tolist()], pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.binary()), pa.array([total[known].tobytes()]), pa.nulls(1, pa.binary())], [*_NAMES, "known"])

    return run


def _counts(batches):
    total = np.zeros(1, np.int64)
    for batch in batches:
        for ids, n in zip(batch.column("doc_ids"), batch.column("data")):
            known = ids.values.to_numpy()
            if known.max(initial=0) >= len(total):
                total = np.concatenate([total, np.zeros(int(known.max()) + 1 - len(total), np.int64)])
            total[known] += np.frombuffer(n.as_buffer(), np.int64)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])


def _ranked(ranks):
    """The blocks with the common ranks."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                known = np.frombuffer(one.column("known")[0].as_buffer(), np.uint32)
                n = sum(one.column("counts")[0].as_py())
                own = unpack(one.column("control")[0].as_py(), one.column("data")[0].as_py(), n)
                control, data = pack(ranks.value[known][own])
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in _NAMES[:5]), pa.array([control]), pa.array([data])], _NAMES)

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode the documents with the ``tokenizers`` file, end each with ``end_id``, and write the folder ``path``.

    Texts are encoded once, into blocks that have ranks of their own and wait in the shared folder
    until the common ranks are known.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    encoded = _spark.saved(ordered.mapInArrow(_encoded(tokenizer, end_id), _BLOCK + ", known binary"), "ids-encoded")
    found = encoded.where("block < 0").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # a row for each id of the vocabulary at most
    ids = np.array([r.id for r in sorted(found, key=lambda r: (-r.n, r.id))], np.int64)
    rank = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
    rank[ids] = np.arange(len(ids))
    spark.createDataFrame([(k, int(i)) for k, i in enumerate(ids)], "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")
    encoded.where("block >= 0").mapInArrow(_ranked(spark.sparkContext.broadcast(rank)), _BLOCK).write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of a folder: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids_crc32`` and, if wanted, ``ids``.

    The sum is that of the ids as little-endian unsigned 32-bit numbers.
    """
    ranks = spark.read.schema("rank int, id long").parquet(f"{path}/ranks").orderBy("rank").collect()  # the vocabulary
    ids = np.array([r.id for r in ranks], np.uint32)
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    sizes = blocks.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    starts: dict[int, int] = {}
    total = 0
    for r in sizes.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # a row for each part file
        starts[r.part] = total
        total += r.n
    shared = spark.sparkContext.broadcast((ids, starts))

    def run(batches):
        known, begin = shared.value
        for batch in batches:
            for part, before, own, counts, control, data in zip(*(batch.column(c) for c in ("part", "before", "doc_ids", "counts", "control", "data"))):
                n = np.array(counts.as_py(), np.int64)
                values = known[unpack(control.as_py(), data.as_py(), int(n.sum()))].astype("<u4")
                to = np.cumsum(n)
                raw = memoryview(values.tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(to - n, to)]
                columns = [own.values, pa.array(begin[part.as_py()] + before.as_py() + to - n), pa.array(n), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], to]), pa.int32()), pa.array(values.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
