"""Row-level transforms of telemetry."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwatch.sources.scratch import written


def moment(value: datetime | Column | None) -> Column:
    """A point in time as a column; None is now."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value)


def span(value: timedelta | str) -> Column:
    """A duration, such as ``"3 days"``, as an interval column."""
    if isinstance(value, timedelta):
        return F.lit(value)
    return F.expr(f"cast('{value}' as interval)")


def parse_time(rows: DataFrame, column: str = "timestamp", into: str | None = None) -> DataFrame:
    """ISO-8601 text to timestamps; what cannot be read is NULL."""
    return rows.withColumn(into or column, F.try_to_timestamp(F.col(column)))


def recent(rows: DataFrame, ts_col: str = "ts", as_of: datetime | Column | None = None, ahead: timedelta | str = "15 minutes") -> DataFrame:
    """Rows that are less than ``ahead`` past ``as_of``: everything but the far future. Nulls are dropped."""
    return rows.where(F.col(ts_col) < moment(as_of) + span(ahead))


def participants(rows: DataFrame, user_col: str = "user_id") -> DataFrame:
    """The distinct non-null ids, one a row."""
    return rows.select(F.col(user_col).alias("user_id")).where("user_id is not null").distinct()


def participant_list(rows: DataFrame, user_col: str = "user_id", distinct: bool = True) -> DataFrame:
    """One row with ``participants_id``, sorted; empty for no rows. For small cohorts only: it grows with them, where :func:`id_blocks` does not."""
    gather = F.collect_set if distinct else F.collect_list
    return rows.agg(F.array_sort(gather(user_col)).alias("participants_id"))


def id_blocks(rows: DataFrame, user_col: str = "user_id", size: int = 1000) -> DataFrame:
    """The distinct non-null ids, sorted and cut into blocks of ``size``: ``block`` (from 1), ``blocks``, ``n_ids`` (all), ``participants_id``.

    For reports on any number of participants: ids are sorted by ranges, a range's first number is the
    count of the ranges before it, and no row holds more than a block. No ids give no rows.
    """
    if size < 1:
        raise ValueError("a block must hold an id at least")
    ids = participants(rows, user_col)
    # The number of a row in its range stands in the low 33 bits, the range in those above.
    numbered = ids.repartitionByRange("user_id").sortWithinPartitions("user_id").withColumn("_at", F.monotonically_increasing_id())
    numbered = written(numbered, "ids").withColumns({"_range": F.shiftright("_at", 33), "_nth": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = numbered.groupBy("_range").agg(F.count("*").alias("_n"))  # a row for each range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(whole).alias("n_ids"))
    placed = numbered.join(F.broadcast(starts), "_range").withColumn("block", F.floor((F.col("_start") + F.col("_nth")) / size) + 1)
    found = placed.groupBy("block", "n_ids").agg(F.array_sort(F.collect_list("user_id")).alias("participants_id"))
    return found.select("block", F.ceil(F.col("n_ids") / size).alias("blocks"), "n_ids", "participants_id")


def flag_spikes(rows: DataFrame, metric: str, threshold: float) -> DataFrame:
    """``is_anomaly``: whether the metric is above the threshold; NULL metrics are no anomaly."""
    return rows.withColumn("is_anomaly", F.coalesce(F.col(metric) > threshold, F.lit(False)))


def spikes_by_user(rows: DataFrame, metric: str, threshold: float, user_col: str = "user_id") -> DataFrame:
    """Spikes and the highest metric of each participant with one."""
    return rows.where(F.col(metric) > threshold).groupBy(user_col).agg(F.count("*").alias("n_spikes"), F.max(metric).alias("max_value"))


def clean(rows: DataFrame, keys: Iterable[str], ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Our standard cleaning: rows with every key, one for each of them, and ranged columns within their range."""
    keys = list(keys)
    rows = rows.na.drop(subset=keys)
    for c, (low, high) in (ranges or {}).items():
        rows = rows.where(F.col(c).between(low, high))
    return rows.dropDuplicates(keys)


def cap_per_group(rows: DataFrame, n: int, group: str = "topic", order: Iterable[str] = ("timestamp", "partition", "offset")) -> DataFrame:
    """The first ``n`` rows of each group in the given order."""
    name = "_nth"
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col(name) <= n).drop(name)


def custom(rows: DataFrame, check: Callable[..., DataFrame], **params) -> DataFrame:
    """A caller's check: a function from DataFrame to DataFrame."""
    return rows.transform(check, **params)


def custom_by_group(rows: DataFrame, group: str, function: Callable, schema: str) -> DataFrame:
    """A caller's pandas function for each group; a group is one task's memory, so keys must stay small."""
    return rows.groupBy(group).applyInPandas(function, schema)


def custom_by_batches(rows: DataFrame, group: str, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """A caller's function over the batches of each group, for groups of any size: a task holds one batch, not the group.

    Batches are as large as ``spark.sql.execution.arrow.maxRecordsPerBatch`` says; what must outlast one is the caller's state.
    """

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return function(parts)

    batches.__annotations__ = {"parts": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}  # types, not their text: they choose the form
    return rows.groupBy(group).applyInPandas(batches, schema)
