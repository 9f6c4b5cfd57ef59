"""A Bloom filter sized by its keys, built in the tasks and sent to them: keys that it misses need no shuffle.

It saves work only: a key that it holds by chance is shuffled and drops out in the join behind it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from cohortwatch.llm import _text

#: Bits for each key, and the sizes (as powers of two) between which a filter has them: 32 MB at most.
KEY_BITS, LEAST, MOST = 10, 20, 28
#: The filter is moved in cells of this many bytes.
CELL = 1 << 12


def _places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    h = _text.mix(keys.view(np.uint64) + np.uint64(0x51))
    return (h >> np.uint64(64 - size)).astype(np.int64), (h & np.uint64((1 << size) - 1)).astype(np.int64)


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each 64-bit key may be in the filter."""
    a, b = _places(keys, len(bits).bit_length() + 2)
    return ((bits[a >> 3] >> (a & 7).astype(np.uint8)) & (bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def _cells(bits: np.ndarray) -> pa.RecordBatch:
    used = np.flatnonzero(bits.reshape(-1, CELL).any(1))
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([zlib.compress(bits[k * CELL : (k + 1) * CELL].tobytes(), 1) for k in used], pa.binary())], ["cell", "bits"])


def _fill(size: int):
    def run(batches):
        bits = np.zeros(1 << size - 3, np.uint8)
        for batch in batches:
            for places in _places(batch.column(0).to_numpy(zero_copy_only=False), size):
                np.bitwise_or.at(bits, places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
        yield _cells(bits)

    return run


def _merge(batches):
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for cell, packed in zip(batch.column("cell").to_pylist(), batch.column("bits").to_pylist()):
            new = np.frombuffer(zlib.decompress(packed), np.uint8)
            held[cell] = held[cell] | new if cell in held else new
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in held.values()], pa.binary())], ["cell", "bits"])


def build(keys: DataFrame, column: str) -> Broadcast:
    """The filter of a long column of a saved table, as a broadcast of ``2 ** (MOST - 3)`` bytes at most."""
    size = min(MOST, max(LEAST, (keys.count() * KEY_BITS).bit_length()))
    schema = "cell int, bits binary"
    cells = keys.select(column).mapInArrow(_fill(size), schema).repartition("cell").mapInArrow(_merge, schema)
    bits = np.zeros(1 << size - 3, np.uint8)
    for r in cells.collect():  # each cell once
        bits[r.cell * CELL : (r.cell + 1) * CELL] = np.frombuffer(zlib.decompress(r.bits), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)
