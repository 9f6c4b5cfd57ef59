"""Presence bitmaps: who sent in which bucket of time, kept as a table that answers any window without the events.

Time is cut into buckets of one cadence, each open on the left and closed on the right, with ``origin``
as one of the ends. A row holds a bit for each of 64 buckets of one participant, as a long; rows of several
tables, or of later days, are merged by bitwise or, so a table grows with participants and time, not with events.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwatch.operators.transforms import moment, participants

#: Bits of a bitmap.
BITS = 64


def _bucket(at: Column, origin: datetime | Column, cadence: timedelta) -> Column:
    """The number of the bucket that ends at or first ends behind a time."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return F.ceil((micros(at) - micros(moment(origin))) / F.lit(cadence // timedelta(microseconds=1)))


def presence(events: DataFrame, cadence: timedelta, origin: datetime | Column, user_col: str = "user_id", ts_col: str = "ts") -> DataFrame:
    """``user_id``, ``bucket`` (the number of a block of 64 buckets), ``bitmap``. Null ids and times are left out.

    A bitmap is eight bytes, so tasks merge them by hash as they go, and nothing is sorted.
    """
    rows = events.where(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull()).select(F.col(user_col).alias("user_id"), _bucket(F.col(ts_col), origin, cadence).alias("n"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("n", F.lit(BITS)).cast("int"))
    return rows.groupBy("user_id", F.floor(F.col("n") / BITS).alias("bucket")).agg(F.bit_or(bit).alias("bitmap"))


def merge_presence(tables: Iterable[DataFrame]) -> DataFrame:
    """One table of several with the same cadence and origin."""
    return reduce(DataFrame.unionByName, tables).groupBy("user_id", "bucket").agg(F.bit_or("bitmap").alias("bitmap"))


def _set_between(bitmap: Column, low: Column, high: Column) -> Column:
    """Bits set from position ``low`` to ``high``."""
    width = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), (BITS - 1 - (high - low)).cast("int"))
    return F.bit_count(F.call_function("shiftrightunsigned", bitmap, low.cast("int")).bitwiseAND(width))


def missing_fraction(table: DataFrame, as_of: datetime | Column, window: timedelta, cadence: timedelta, origin: datetime | Column, threshold: float = 0.0, roster: DataFrame | None = None, user_col: str = "user_id") -> DataFrame:
    """As :func:`cohortwatch.operators.checks.missing_fraction`, from a presence table of this cadence and origin: ``user_id``, ``missing_fraction``.

    ``as_of`` must be an end of a bucket, else the bucket it lies in counts as its last.
    """
    if window < cadence or not cadence:
        raise ValueError("the window must hold a bucket at least")
    expected = int(window / cadence)
    end = _bucket(moment(as_of), origin, cadence)
    # Buckets end - expected + 1 to end, as bit positions of each block.
    base = F.col("bucket") * BITS
    low, high = F.greatest(end - expected + 1 - base, F.lit(0)), F.least(end - base, F.lit(BITS - 1))
    inside = F.when(low <= high, _set_between(F.col("bitmap"), low, high)).otherwise(0)
    seen = table.groupBy("user_id").agg(F.sum(inside).alias("n"))
    found = seen if roster is None else participants(roster, user_col).join(seen, "user_id", "left")
    fraction = 1 - F.coalesce("n", F.lit(0)).cast("double") / F.lit(float(expected))
    return found.select("user_id", fraction.alias("missing_fraction")).where(F.col("missing_fraction") >= threshold)
