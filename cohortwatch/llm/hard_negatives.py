"""Hard-negative mining with Four-Russians scoring.

Vectors become integers, ``floor(scale * x)``. Eight dimensions are a group: for each of a tile of
anchors and each group the sums of all 256 subsets of the anchor's eight components stand in a table.
A candidate is packed into bit planes (two's complement), a byte for each group and plane. Its score
with all anchors of the tile is, from the sign plane down, the doubled sum so far plus the table rows
that the plane's bytes name: the full inner product, exact.

The anchors are a stated query set against all rows. They are taken in blocks of about
``anchor_rows``; each block is sent to the tasks and two passes over all rows follow: the best rows
of the same label, and, by their scores, the best rows of other labels in each positive's interval.
A task keeps only its best rows of each list and Spark merges those of all tasks.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows
equal in id, label and vector count once; rows that share an id only are rows of their own. Shorter
vectors count as padded with zeros. Equal scores are ordered by id. No anchor, or an empty table, gives
no rows. Other columns are ignored, whatever their names. Scores that might pass 64 bits are a ValueError.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwatch.llm import _spark

#: Dimensions of a group, anchors whose tables are held at once, candidates scored at once, rows of a task.
GROUP, TILE, BLOCK, TASK_ROWS = 8, 256, 4096, 8192
#: Anchors sent to the tasks at once, about: 8 bytes a component.
ANCHOR_ROWS = 16_384

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """For anchors (n, d): the sums of each group's subsets, (groups, 256, n); bit j of the subset's number is the group's dimension j."""
    n, d = anchors.shape
    groups = -(-d // GROUP)
    parts = np.zeros((groups * GROUP, n), anchors.dtype)
    parts[:d] = anchors.T
    parts = parts.reshape(groups, GROUP, n)
    sums = np.zeros((groups, 1 << GROUP, n), anchors.dtype)
    for j in range(GROUP):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + parts[:, j, None]
    return sums


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """Vectors (n, d) packed: (planes, groups, n) bytes, the lowest plane first, the sign plane last."""
    n, d = vectors.shape
    low, high = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
    width = max((~low).bit_length() if low < 0 else 0, high.bit_length() if high > 0 else 0) + 1
    planes = np.empty((width, -(-d // GROUP), n), np.uint8)
    for b in range(width):
        planes[b] = np.packbits((vectors >> b & 1).astype(np.uint8), axis=1, bitorder="little").T
    return planes


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of the packed vectors with the anchors of the tables, (vectors, anchors)."""
    n, (_, _, anchors) = planes.shape[2], sums.shape
    total, row = np.zeros((n, anchors), sums.dtype), np.empty((n, anchors), sums.dtype)
    for b in range(len(planes) - 1, -1, -1):
        total += total
        for table, byte in zip(sums, planes[b]):
            np.take(table, byte, axis=0, out=row, mode="clip")
            if b == len(planes) - 1:
                total -= row
            else:
                total += row
    return total


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` of each group by score from the top and id, ordered so."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    start = np.ones(len(g), bool)
    start[1:] = g[1:] != g[:-1]
    nth = np.arange(len(g)) - np.flatnonzero(start)[np.cumsum(start) - 1]
    return order[nth < k]


class Best:
    """The best ``k`` of ``groups`` lists, as far as rows have been seen."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: The last score that a full list holds: rows below it are of no use.
        self.least = np.full(groups, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(group):
            group, score, ids = np.concatenate([self.group, group]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
            kept = best(group, score, ids, self.k)
            self.group, self.score, self.id = group[kept], score[kept], ids[kept]
            last = np.bincount(self.group, minlength=len(self.least))[self.group] == self.k
            ends = np.append(self.group[1:] != self.group[:-1], True) & last
            self.least[self.group[ends]] = self.score[ends]


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix, padded with zeros or as wide as its widest row."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(vectors.offsets.to_numpy())
    width = max(width, int(lengths.max()) if len(lengths) else 0)
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy()
    return out


class Anchors:
    """A block of anchors, sent to the tasks."""

    def __init__(self, rows: list):
        self.id = np.array([r.id for r in rows], np.int64)
        self.label = np.array([r.label for r in rows], np.int64)
        self.vector = _matrix(pa.array([r.vector for r in rows], pa.list_(pa.int64())), 0)
        self.width = self.vector.shape[1]
        self.top = int(np.abs(self.vector).max(initial=0))

    def scored(self, batch: pa.RecordBatch):
        """Tile by tile of the anchors, and block by block of the candidates: first anchor, ids, labels, vectors, scores."""
        ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
        vectors = _matrix(batch.column("vector"), self.width)
        reach = max(1, self.top) * int(np.abs(vectors).max(initial=1)) * 2 * max(1, vectors.shape[1])
        if reach >= 1 << 63:
            raise ValueError("scores may pass 64 bits")
        kind = np.int32 if reach < 1 << 31 else np.int64
        own = np.zeros((len(self.id), vectors.shape[1]), kind)
        own[:, : self.width] = self.vector
        packed = [(slice(k, k + BLOCK), bit_planes(vectors[k : k + BLOCK])) for k in range(0, len(ids), BLOCK)]
        for a in range(0, len(self.id), TILE):
            sums = subset_sums(own[a : a + TILE])
            for at, planes in packed:
                yield a, ids[at], labels[at], vectors[at], scores(sums, planes)


def _positives(anchors, k: int):
    def run(batches):
        own = anchors.value
        found = Best(len(own.id), k)
        for batch in batches:
            for a, ids, labels, vectors, score in own.scored(batch):
                tile = slice(a, a + score.shape[1])
                row, col = np.nonzero((labels[:, None] == own.label[tile]) & (score >= found.least[tile]))
                itself = np.flatnonzero(ids[row] == own.id[tile][col])  # same id and label: the anchor, if the vectors are one
                if len(itself):
                    mine = own.vector[tile][col[itself]]
                    theirs = vectors[row[itself]]
                    other = (theirs[:, : own.width] != mine).any(1) | (theirs[:, own.width :] != 0).any(1)
                    keep = np.ones(len(row), bool)
                    keep[itself[~other]] = False
                    row, col = row[keep], col[keep]
                found.add(a + col, score[row, col].astype(np.int64), ids[row])
        yield pa.RecordBatch.from_arrays([pa.array(found.group), pa.array(found.score), pa.array(found.id)], ["anchor", "score", "id"])

    return run


def _negatives(anchors, pairs, k: int):
    def run(batches):
        own, (first, count, positive, positive_score, low, high) = anchors.value, pairs.value
        found = Best(len(positive), k)
        many = int(count.max(initial=0))
        for batch in batches:
            for a, ids, labels, _, score in own.scored(batch):
                n = score.shape[1]
                # An anchor's widest interval, from the bottom that its lists still leave open.
                bottom, top = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
                for j in range(many):
                    has = np.flatnonzero(count[a : a + n] > j)
                    p = first[a + has] + j
                    bottom[has] = np.minimum(bottom[has], np.maximum(low[p], found.least[p]))
                    top[has] = np.maximum(top[has], high[p])
                row, col = np.nonzero((score >= bottom) & (score <= top) & (labels[:, None] != own.label[a : a + n]))
                value, of, ends = score[row, col].astype(np.int64), ids[row], a + col
                for j in range(many):
                    has = count[ends] > j
                    p = first[ends[has]] + j
                    fits = (value[has] >= np.maximum(low[p], found.least[p])) & (value[has] <= high[p])
                    found.add(p[fits], value[has][fits], of[has][fits])
        owner = np.repeat(np.arange(len(count)), count)[found.group]
        columns = [own.id[owner], positive[found.group], found.group, positive_score[found.group], found.id, found.score]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "positive_id", "pair", "positive_score", "negative_id", "negative_score"])

    return run


def _first(partial: DataFrame, by: str, score: str, ids: str, k: int) -> DataFrame:
    """The first ``k`` of each list among the tasks' best rows, with ``rank``."""
    order = Window.partitionBy(by).orderBy(F.desc(score), ids)
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, query: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 5, percent: tuple[int, int] = (80, 100), scale: int = 256, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """Hard negatives of the rows that ``query`` holds for: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    An anchor's positives are its ``positives`` best other rows of its label. Each is returned with the first
    ``negatives`` rows of other labels whose score is between ``percent[0]`` and ``percent[1]`` percent of the
    positive's; ranks count from 1 among those. All rows are scored with all anchors.
    """
    spark = rows.sparkSession
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    known = F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & vector.isNotNull() & finite
    taking = rows.where(known).select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.xxhash64(f"`{label_col}`").alias("label"),
        F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x)).alias("vector"),
        F.coalesce(query, F.lit(False)).alias("anchor"),
    )
    parts = max(1, -(-rows.count() // TASK_ROWS))
    table = _spark.saved(taking.dropDuplicates(["id", "label", "vector"]).repartition(parts, "id", F.xxhash64("vector")), "vectors")
    anchors = table.where("anchor")
    blocks = -(-anchors.count() // anchor_rows)
    out = []
    for b in range(blocks):
        block = anchors.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)) == b).select("id", "label", "vector").collect()  # about anchor_rows
        if block:
            out.append(_mined(table, spark.sparkContext.broadcast(Anchors(block)), positives, negatives, percent))
    result = spark.createDataFrame([], RESULT) if not out else out[0]
    for more in out[1:]:
        result = result.unionAll(more)
    return result


def _mined(table: DataFrame, anchors, positives: int, negatives: int, percent: tuple[int, int]) -> DataFrame:
    """The result of one block of anchors."""
    table = table.select("id", "label", "vector")
    near = _first(table.mapInArrow(_positives(anchors, positives), "anchor long, score long, id long"), "anchor", "score", "id", positives)
    pairs = sorted((r.anchor, r.rank, r.id, r.score) for r in near.collect())  # some for each anchor of the block
    count = np.bincount(np.array([p[0] for p in pairs], np.int64), minlength=len(anchors.value.id))
    first = np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
    positive, score = (np.array([p[k] for p in pairs], np.int64) for k in (2, 3))
    low = np.array([-(-percent[0] * p[3] // 100) for p in pairs], np.int64)
    high = np.array([percent[1] * p[3] // 100 for p in pairs], np.int64)
    sent = table.sparkSession.sparkContext.broadcast((first, count, positive, score, low, high))
    partial = table.mapInArrow(_negatives(anchors, sent, negatives), "anchor_id long, positive_id long, pair long, positive_score long, negative_id long, negative_score long")
    found = _first(partial, "pair", "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
