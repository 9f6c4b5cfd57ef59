"""Data checks. Results are long: one row for each finding."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwatch.operators.transforms import moment, participants, span
from cohortwatch.sources.readers import CORRUPT


def missing_participants(events: DataFrame, as_of: datetime | Column, window: timedelta | str, roster: DataFrame | None = None, user_col: str = "user_id", ts_col: str = "ts") -> DataFrame:
    """Participants without an event in ``(as_of - window, as_of]``: threshold 1, all data missing.

    Who should be there comes from ``roster`` or, without one, from all of ``events``, so that ids
    never seen are only missed by a roster. With ``last_seen``, the last event up to ``as_of``.
    """
    now = moment(as_of)
    events = events.where(F.col(user_col).isNotNull())
    # One scan and one aggregate, which a roster is joined to: the last event tells who is silent.
    last = events.groupBy(F.col(user_col).alias("user_id")).agg(F.max(F.when(F.col(ts_col) <= now, F.col(ts_col))).alias("last_seen"))
    found = last if roster is None else participants(roster, user_col).join(last, "user_id", "left")
    return found.where(F.col("last_seen").isNull() | (F.col("last_seen") <= now - span(window))).select("user_id", "last_seen")


def missing_fraction(events: DataFrame, as_of: datetime | Column, window: timedelta, cadence: timedelta, threshold: float = 0.0, roster: DataFrame | None = None, user_col: str = "user_id", ts_col: str = "ts") -> DataFrame:
    """The share of a participant's ``cadence`` long buckets in the window that have no event, where at least ``threshold``.

    Our reading of a fractional threshold: buckets are counted back from ``as_of``.
    """
    if window < cadence or not cadence:
        raise ValueError("the window must hold a bucket at least")
    expected = int(window / cadence)
    now = moment(as_of)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    bucket = F.floor((micros(now) - micros(F.col(ts_col))) / F.lit(cadence // timedelta(microseconds=1)))
    inside = (F.col(ts_col) > now - F.lit(window)) & (F.col(ts_col) <= now) & (bucket < expected)
    seen = events.where(F.col(user_col).isNotNull()).select(F.col(user_col).alias("user_id"), F.when(inside, bucket).alias("bucket")).groupBy("user_id").agg(F.countDistinct("bucket").alias("n"))
    found = seen if roster is None else participants(roster, user_col).join(seen, "user_id", "left")
    fraction = 1 - F.coalesce("n", F.lit(0)).cast("double") / F.lit(float(expected))
    return found.select("user_id", fraction.alias("missing_fraction")).where(F.col("missing_fraction") >= threshold)


def without_recent_alerts(found: DataFrame, alerts: DataFrame, as_of: datetime | Column, backoff: timedelta | str, user_col: str = "user_id") -> DataFrame:
    """Our reading of backoff: findings on participants not alerted within it before ``as_of``."""
    recent = alerts.where((F.col("alerted_at") > moment(as_of) - span(backoff)) & (F.col("alerted_at") <= moment(as_of))).select(F.col("user_id").alias("_alerted")).distinct()
    return found.join(recent, F.col(user_col) == F.col("_alerted"), "left_anti")


def alert_log(found: DataFrame, action: str, as_of: datetime | Column, user_col: str = "user_id") -> DataFrame:
    """What to append to the log: ``action``, ``user_id``, ``alerted_at``."""
    return found.select(F.lit(action).alias("action"), F.col(user_col).alias("user_id"), moment(as_of).alias("alerted_at"))


def quality_metrics(rows: DataFrame, columns: Iterable[str], ranges: dict[str, tuple[float, float]] | None = None, keys: Iterable[str] | None = None, threshold: float = 0.0) -> DataFrame:
    """Our data-quality check: ``metric``, ``column``, ``fraction`` where that is at least ``threshold``.

    All in one scan: with ``keys`` counts are added up by key first, so that the duplicate fraction, the share of
    rows beyond the first of their key, comes from the same rows. No rows have fraction 0.
    """
    columns, ranges, keys = list(columns), ranges or {}, list(keys or ())
    kinds = [("null", c, F.count_if(F.col(c).isNull())) for c in columns]
    kinds += [("out_of_range", c, F.count_if(~F.col(c).between(low, high))) for c, (low, high) in ranges.items()]
    if not kinds and not keys:
        raise ValueError("nothing to measure")
    counts = [count.alias(f"_m{i}") for i, (_, _, count) in enumerate(kinds)]
    wide = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("_n"), *counts)
    if keys:
        wide = wide.agg(F.sum("_n").alias("_n"), *[F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(kinds))], (F.sum("_n") - F.count("*")).alias("_again"))
    share = lambda c: F.coalesce(F.col(c).cast("double") / F.nullif(F.col("_n"), F.lit(0)), F.lit(0.0))
    entries = [F.struct(F.lit(kind).alias("metric"), F.lit(c).alias("column"), share(f"_m{i}").alias("fraction")) for i, (kind, c, _) in enumerate(kinds)]
    if keys:
        entries.append(F.struct(F.lit("duplicate").alias("metric"), F.lit(",".join(keys)).alias("column"), share("_again").alias("fraction")))
    return wide.select(F.inline(F.array(*entries))).where(F.col("fraction") >= threshold)


def schema_violations(decoded: DataFrame, required: Iterable[str] = (), topic_col: str = "topic") -> DataFrame:
    """Our schema check on decoded messages: ``topic``, ``reason`` (corrupt, or null and the field's name), ``n``."""
    good = F.col(CORRUPT).isNull()
    reasons = F.array_compact(F.array(F.when(~good, F.lit("corrupt")), *[F.when(good & F.col(c).isNull(), F.lit(f"null {c}")) for c in required]))
    topic = F.col(topic_col) if topic_col in decoded.columns else F.lit(None).cast("string")
    return decoded.select(topic.alias("topic"), F.explode(reasons).alias("reason")).groupBy("topic", "reason").agg(F.count("*").alias("n"))
