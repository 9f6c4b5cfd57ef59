"""Archived messages: topics kept as Parquet with the columns of the message envelope, read by offset ranges.

A pull takes of every topic and partition the offsets from its position on, writes them as one numbered
folder, and then writes the new positions under the same number. A pull that fails before that is done again under
its number and writes over what it left, so every message arrives once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Ranges that are put into the scan as predicates; more are joined.
PREDICATES = 200
_POSITIONS = "topic string, partition int, until long, pull int"


def ends(messages: DataFrame) -> DataFrame:
    """Of each topic and partition its first offset and the one behind its last: ``topic``, ``partition``, ``low``, ``high``."""
    return messages.groupBy("topic", "partition").agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))


def ranges(messages: DataFrame, positions: DataFrame | None = None, topics: list[str] | None = None, most: int | None = None) -> DataFrame:
    """What is to be read: ``topic``, ``partition``, ``start``, ``until``. Parts without new messages are left out.

    ``most`` bounds a topic's offsets, shared by its partitions in their order; offsets are counted, not messages, so gaps count.
    """
    found = ends(messages if topics is None else messages.where(F.col("topic").isin(topics)))
    if positions is None:
        found = found.withColumn("start", F.col("low"))
    else:
        found = found.join(positions.select("topic", "partition", "until"), ["topic", "partition"], "left").withColumn("start", F.greatest("low", "until")).drop("until")
    found = found.where("start < high").select("topic", "partition", "start", F.col("high").alias("until"))
    if most is None:
        return found
    taken = F.coalesce(F.sum(F.col("until") - F.col("start")).over(Window.partitionBy("topic").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumn("left", F.lit(most) - taken).where("left > 0").select("topic", "partition", "start", F.least("until", F.col("start") + F.col("left")).alias("until"))


def read_ranges(messages: DataFrame, wanted: DataFrame) -> DataFrame:
    """The messages of these ranges. Few ranges are predicates on topic, partition and offset, which prune files and row groups; more are joined."""
    rows = wanted.limit(PREDICATES + 1).collect()
    if not rows:
        return messages.limit(0)
    if len(rows) <= PREDICATES:
        return messages.where(reduce(lambda a, b: a | b, [(F.col("topic") == r.topic) & (F.col("partition") == r.partition) & (F.col("offset") >= r.start) & (F.col("offset") < r.until) for r in rows]))
    inside = (F.col("m.topic") == F.col("w.topic")) & (F.col("m.partition") == F.col("w.partition")) & (F.col("m.offset") >= F.col("w.start")) & (F.col("m.offset") < F.col("w.until"))
    return messages.alias("m").join(wanted.alias("w"), inside, "left_semi")


def positions(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest positions of a reader, with their pull's number; None before the first."""
    try:
        kept = spark.read.schema(_POSITIONS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return kept.where(F.col("pull") == kept.agg(F.max("pull")).scalar())


def pull(messages: DataFrame, out: str, kept: str, topics: list[str] | None = None, most: int | None = None) -> int:
    """One pull from the archive ``messages`` into ``out``/pull=n, with positions in ``kept``; the pull's number. Without new messages nothing is written (-1)."""
    spark = messages.sparkSession
    before = positions(spark, kept)
    row = before.first() if before is not None else None
    number = row.pull + 1 if row else 0
    wanted = ranges(messages, before, topics, most).cache()  # a row for each topic and partition
    try:
        if wanted.isEmpty():
            return -1
        read_ranges(messages, wanted).write.mode("overwrite").parquet(f"{out}/pull={number}")
        new = wanted.select("topic", "partition", "until")
        if before is not None:
            new = new.unionByName(before.select("topic", "partition", "until").join(new, ["topic", "partition"], "left_anti"))
        new.coalesce(1).write.mode("overwrite").parquet(f"{kept}/pull={number}")  # one file: positions appear at once
        return number
    finally:
        wanted.unpersist()
