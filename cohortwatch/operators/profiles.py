"""Daily profiles: counts and sketches by topic and day, merged over any days without reading the rows again.

Counts are exact. Distinct values come from an HLL sketch, quantiles from a KLL sketch; both are Spark's own
and merge without further error. Duplicates need the rows: see ``checks.quality_metrics``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the sketches: log2 of the HLL registers, and the KLL's k.
REGISTERS, K = 12, 200


def daily_profiles(rows: DataFrame, columns: Iterable[str], keys: Iterable[str] = (), ranges: dict[str, tuple[float, float]] | None = None, topic_col: str = "topic", ts_col: str = "ts") -> DataFrame:
    """One scan: ``topic``, ``day``, ``n_rows`` and for each column its ``null_``, ``out_``, ``quantiles_`` (numeric), for each key its ``distinct_`` part.

    A row without a time has a null day. Quantiles leave nulls and NaN out.
    """
    columns, ranges, kinds = list(columns), ranges or {}, dict(rows.dtypes)
    parts = [F.count("*").alias("n_rows")]
    for c in columns:
        parts.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
        if c in ranges:
            parts.append(F.count_if(~F.col(c).between(*ranges[c])).alias(f"out_{c}"))
        if kinds[c].startswith(("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")):
            value = F.col(c).cast("double")
            parts.append(F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(K)).alias(f"quantiles_{c}"))
    parts += [F.hll_sketch_agg(F.col(k).cast("string"), F.lit(REGISTERS)).alias(f"distinct_{k}") for k in keys]
    return rows.groupBy(F.col(topic_col).alias("topic"), F.to_date(ts_col).alias("day")).agg(*parts)


def merge_profiles(profiles: DataFrame, by: Iterable[str] = ("topic",)) -> DataFrame:
    """Profiles added up by ``by``: any of ``topic`` and ``day``, or nothing for one row of all."""
    parts = []
    for c in profiles.columns:
        if c.startswith("quantiles_"):
            parts.append(F.kll_merge_agg_double(c, F.lit(K)).alias(c))
        elif c.startswith("distinct_"):
            parts.append(F.hll_union_agg(c).alias(c))
        elif c not in ("topic", "day"):
            parts.append(F.sum(c).alias(c))
    return profiles.groupBy(*by).agg(*parts)


def quantile(column: str, q: float) -> Column:
    """The value at rank ``q`` of a profile's column."""
    return F.kll_sketch_get_quantile_double(F.col(f"quantiles_{column}"), F.lit(float(q)))


def distinct(key: str) -> Column:
    """The estimated number of a profile's distinct values of a key."""
    return F.hll_sketch_estimate(f"distinct_{key}")


def fractions(profiles: DataFrame) -> DataFrame:
    """The shares of nulls and of values out of range, long: the profiles' keys, ``metric``, ``column``, ``fraction``."""
    keys = [c for c in ("topic", "day") if c in profiles.columns]
    entries = []
    for prefix, metric in (("null_", "null"), ("out_", "out_of_range")):
        entries += [F.struct(F.lit(metric).alias("metric"), F.lit(c.removeprefix(prefix)).alias("column"), (F.col(c) / F.col("n_rows")).alias("fraction")) for c in profiles.columns if c.startswith(prefix)]
    if not entries:
        raise ValueError("the profiles have no shares")
    return profiles.select(*keys, F.inline(F.array(*entries)))
