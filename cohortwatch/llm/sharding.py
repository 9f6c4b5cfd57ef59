"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (rows of equal text) are sorted by size and each enters the bin with the least remaining
capacity that still holds it, found in a balanced tree of the remaining capacities (:class:`Bins`).

With a **fixed capacity** the groups are dealt to tasks by a hash, ``PACK_GROUPS`` or so each, and every task packs
its own, largest first. Best fit leaves a task one bin at most that is no more than half full; these are
packed once more, whole. So no shard is over capacity (but one group that is larger has a shard to itself), none is
split over tasks, and the loss against packing in one task is part of a bin for each task.

With a **number of shards** their least capacity is wanted, for which all bins compete. What is packed is bounded:

* groups larger than ``total / (shards * fine)`` enter one by one; there are fewer than ``shards * fine`` of
  them, as their sizes add up to the total at most, and ``fine`` keeps that below ``ONE_BY_ONE``;
* the others are first gathered, by a hash of their key, into parcels of geometrically
  falling expected size, so that the last parcels fill what the large ones leave open.

The row number inside a shard comes from counts of (shard, cell), where a cell is a hash class of
about ``CELL_ROWS`` rows: no task orders a whole shard or a whole group.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwatch.llm import _spark

FINE, ONE_BY_ONE = 1000, 200_000
#: Parcels of small groups: at least so many, and so many for each shard.
PARCELS, PARCELS_EACH = 4092, 12
LEVELS = 6
CELL_ROWS = 20_000
PACK_GROUPS = 1_000_000


class Bins:
    """Open bins by remaining capacity: a tree of two levels whose leaves are split in halves beyond ``LEAF`` entries."""

    LEAF = 256

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.tops: list[tuple[int, int]] = []  # the last entry of each leaf but the last one

    def add(self, room: int, bin_: int) -> None:
        k = bisect_left(self.tops, (room, bin_))
        leaf = self.leaves[k]
        leaf.insert(bisect_right(leaf, (room, bin_)), (room, bin_))
        if len(leaf) > self.LEAF:
            half = len(leaf) // 2
            self.leaves[k : k + 1] = [leaf[:half], leaf[half:]]
            self.tops.insert(k, leaf[half - 1])

    def _take(self, k: int, at: int) -> tuple[int, int]:
        found = self.leaves[k].pop(at)
        if not self.leaves[k] and len(self.leaves) > 1:
            del self.leaves[k]
            del self.tops[min(k, len(self.tops) - 1)]
        return found

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out the bin with the least room of at least ``size``."""
        k = bisect_left(self.tops, (size, -1))
        while k < len(self.leaves):
            at = bisect_left(self.leaves[k], (size, -1))
            if at < len(self.leaves[k]):
                return self._take(k, at)
            k += 1
        return None

    def emptiest(self) -> tuple[int, int]:
        """Takes out the bin with the most room."""
        return self._take(len(self.leaves) - 1, len(self.leaves[-1]) - 1)


class Packer:
    """Best fit for items that come largest first."""

    def __init__(self, capacity: int, bins: int | None = None):
        self.capacity, self.bins, self.open = capacity, bins, Bins()
        self.used: list[int] = [0] * (bins or 0)
        for b in range(bins or 0):
            self.open.add(capacity, b)

    def put(self, size: int) -> int:
        """The item's bin. Without a number of bins a new one opens if none holds it, else it goes to the emptiest, over capacity."""
        found = self.open.tightest(size)
        if found is None and self.bins is None:
            found = self.capacity, len(self.used)
            self.used.append(0)
        room, b = found or self.open.emptiest()
        self.used[b] += size
        if room > size or self.bins is not None:
            self.open.add(room - size, b)
        return b


def best_fit_decreasing(sizes: list[tuple[int, object]], capacity: int, bins: int | None = None) -> tuple[dict, list[int]]:
    """Bin of every item, and the bins' loads. Largest first, ties by key."""
    packer = Packer(capacity, bins)
    return {key: packer.put(size) for size, key in sorted(sizes, key=lambda x: (-x[0], x[1]))}, packer.used


def _pack_task(capacity: int):
    def run(batches):
        packer, part = Packer(capacity), TaskContext.get().partitionId()
        for batch in batches:
            bins = [packer.put(size) for size in batch.column("size").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("size"), batch.column("n"), pa.array([part] * len(bins), pa.int32()), pa.array(bins, pa.int64())], ["key", "size", "n", "part", "bin"])

    return run


def pack(groups: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """``(key, n, shard)`` of ``groups(key, size, n)`` in shards of ``capacity``, and how many shards there are."""
    tasks = max(1, -(-groups.count() // PACK_GROUPS))
    dealt = groups.repartition(tasks, "key").sortWithinPartitions(F.col("size").desc(), "key")
    packed = _spark.saved(dealt.mapInArrow(_pack_task(capacity), "key string, size long, n long, part int, bin long"), "shard-packed")
    bins = packed.groupBy("part", "bin").agg(F.sum("size").alias("load"))
    light = 2 * F.col("load") <= capacity
    parts = bins.groupBy("part").agg(F.count("*").alias("bins"), F.max(F.when(light, F.col("bin"))).alias("light"), F.max(F.when(light, F.col("load"))).alias("load")).orderBy("part").collect()  # a row a task
    where, used = best_fit_decreasing([(r.load, r.part) for r in parts if r.light is not None], capacity)
    full, plan = sum(r.bins - (r.light is not None) for r in parts), []
    start = 0
    for r in parts:
        plan.append((r.part, start, r.light, None if r.light is None else full + where[r.part]))
        start += r.bins - (r.light is not None)
    if not plan:
        return packed.select("key", "n", F.lit(0).alias("shard")), 0
    table = F.broadcast(groups.sparkSession.createDataFrame(plan, "part int, start long, light long, merged long"))
    shard = F.when(F.col("bin") == F.col("light"), F.col("merged")).otherwise(F.col("start") + F.col("bin") - F.when(F.col("bin") > F.col("light"), 1).otherwise(0))
    return packed.join(table, "part").select("key", "n", shard.cast("int").alias("shard")), full + len(used)


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text plus one for its end; null has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _parcel(key: Column, parcels: int) -> Column:
    """Three quarters of the hash space go to the first of ``LEVELS`` equal parts of the parcels, three quarters of the rest to the next one, and so on."""
    h = F.pmod(F.xxhash64(key), F.lit(1 << 20))
    level = F.lit(0)
    for k in range(1, LEVELS):
        level = F.when(h >= F.lit((1 << 20) - ((1 << 20) >> (2 * k))), F.lit(k)).otherwise(level)
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(parcels // LEVELS)).cast("int") * LEVELS + level


def _near_equal(rows: DataFrame, groups: DataFrame, total: int, shards: int, key: str, at: str) -> DataFrame:
    """``rows`` with their shard ``at``, in shards of near-equal size; the plan is small, so no row is moved."""
    fine = max(1, total // (shards * max(1, min(FINE, ONE_BY_ONE // shards))))
    parcels = max(PARCELS, PARCELS_EACH * shards) // LEVELS * LEVELS
    large = [(r.size, r.key) for r in groups.where(F.col("size") > fine).select("key", "size").collect()]  # their sizes bound their number
    unit = lambda c: _parcel(F.col(c), parcels).cast("string")
    small = [(r.size, r.parcel) for r in groups.where(F.col("size") <= fine).groupBy(unit("key").alias("parcel")).agg(F.sum("size").alias("size")).collect()]  # a row a parcel
    where, _ = best_fit_decreasing(large + small, -(-total // shards), shards)
    big, of = _spark.free_name(rows, "big_key"), _spark.free_name(rows, "group_unit")
    spark = rows.sparkSession
    one_by_one = spark.createDataFrame([(k,) for _, k in large], f"{big} string")  # ONE_BY_ONE rows at most
    plan = spark.createDataFrame(list(where.items()), f"{of} string, {at} int")  # these and the parcels
    sorted_ = rows.join(F.broadcast(one_by_one), F.col(key) == F.col(big), "left").withColumn(of, F.coalesce(F.col(big), unit(key)))
    return sorted_.join(F.broadcast(plan), of)


def assign_shards(docs: DataFrame, shards: int = 16, text_col: str = "text", size: Column | None = None, capacity: int | None = None) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` appended; rows of equal text share a shard.

    With ``shards``, the least capacity of near-equal shards is used, so sizes differ by about the
    smallest parcel unless one group alone is larger. With ``capacity`` instead, as many shards
    open as best fit needs and none is larger; a group larger than the capacity has a shard to itself. ``slot``
    numbers a shard's rows from 0 without gaps, in an order that reruns repeat for rows that
    differ. Null texts are one group of size 1 each row, as the empty text is another; an empty
    table gives an empty result. A column named shard or slot in ``docs`` gives way.
    """
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    kinds = dict(docs.dtypes)
    text = F.col(f"`{text_col}`").cast("string")
    key_name, size_name, cell_name = (_spark.free_name(docs, x) for x in ("group_key", "group_size", "cell"))
    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.coalesce(F.md5(text), F.lit("null")).alias(key_name), (size_of(text) if size is None else size).alias(size_name))
    groups = _spark.saved(rows.groupBy(F.col(key_name).alias("key")).agg(F.sum(size_name).alias("size"), F.count("*").alias("n")), "shard-groups")
    total, n = (x or 0 for x in groups.agg(F.sum("size"), F.sum("n")).first())
    at_name = _spark.free_name(docs, "group_shard")
    rows = rows.drop(size_name)
    if capacity is None:
        placed = _near_equal(rows, groups, total, shards, key_name, at_name)
    else:
        plan, shards = pack(groups, capacity)
        placed = _placed(rows, plan.select(F.col("key").alias(key_name), "n", F.col("shard").alias(at_name)), key_name, n)
    cells = max(1, n // (CELL_ROWS * max(1, shards)))
    plain = [c for c in own if c.lower() != text_col.lower() and not kinds[c].startswith(("map", "variant"))]
    placed = placed.withColumn(cell_name, F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in plain] or [F.col(key_name)]), F.lit(cells)).cast("int"))
    counts = placed.groupBy(F.col(at_name).alias("s"), F.col(cell_name).alias("c")).agg(F.count("*").alias("rows"))
    before = counts.select("s", "c", F.coalesce(F.sum("rows").over(Window.partitionBy("s").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    order = [F.col(f"`{c}`") for c in plain if not kinds[c].startswith(("struct<", "array"))]
    numbered = placed.withColumn("nth", F.row_number().over(Window.partitionBy(at_name, cell_name).orderBy(*order, key_name)) - 1)
    out = numbered.join(before, (F.col(at_name) == F.col("s")) & (F.col(cell_name) == F.col("c")))
    return out.select(*[F.col(f"`{c}`") for c in own], F.col(at_name).alias("shard"), (F.col("nth") + F.col("before")).cast("int").alias("slot"))


def _placed(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with their group's shard. The plan's groups are as many as the distinct texts, so they are joined by shuffle, hot ones apart."""
    n = _spark.free_name(rows, "n")
    table = table.withColumnRenamed("n", n)
    hot = F.col(n) * _spark.HOT_KEYS > total
    if total <= _spark.HOT_KEYS:
        return rows.join(F.broadcast(table.drop(n)), key)
    often, seldom = table.where(hot).drop(n), table.where(~hot).drop(n)
    return rows.join(F.broadcast(often), key).unionByName(rows.join(F.broadcast(often.select(key)), key, "left_anti").join(seldom, key))
