"""Schemas of untyped messages: the fields that a topic's VARIANT payloads have, and how they change."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def topic_schemas(decoded: DataFrame, by: Iterable[str] = ("topic",), payload: str = "payload") -> DataFrame:
    """The merged schema of each group's payloads: ``by``, ``schema`` (Spark's text of it), ``n``."""
    return decoded.groupBy(*by).agg(F.schema_of_variant_agg(payload).alias("schema"), F.count("*").alias("n"))


def topic_fields(decoded: DataFrame, by: Iterable[str] = ("topic",), payload: str = "payload") -> DataFrame:
    """The fields of each group's objects: ``by``, ``field``, ``type`` (merged over all its values), ``n`` (payloads that have it).

    Payloads that are no objects have none. Fields inside fields are part of the type.
    """
    spark, by = decoded.sparkSession, list(by)
    # Lists have positions and no keys; objects have both.
    opened = decoded.select(*by, payload).lateralJoin(spark.tvf.variant_explode(F.col(payload).outer()))
    return opened.where("key is not null").groupBy(*by, F.col("key").alias("field")).agg(F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("n"))


def drift(before: DataFrame, after: DataFrame, by: Iterable[str] = ("topic",)) -> DataFrame:
    """What changed between two results of :func:`topic_fields`: ``by``, ``field``, ``change`` (added, lost, changed), ``type_before``, ``type_after``.

    A field whose values were or are all null (type VOID) has not changed by that. A group that is absent on one side has all its fields added or lost.
    """
    by = list(by)
    a = before.select(*by, "field", F.col("type").alias("type_before"))
    b = after.select(*by, "field", F.col("type").alias("type_after"))
    was, now = F.col("type_before"), F.col("type_after")
    both = (was != now) & (was != "VOID") & (now != "VOID")
    change = F.when(was.isNull(), "added").when(now.isNull(), "lost").when(both, "changed")
    keys = [*by, "field"]
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = a.alias("a").join(b.alias("b"), on, "full")
    rows = joined.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], "type_before", "type_after")
    return rows.select(*keys, change.alias("change"), "type_before", "type_after").where("change is not null")
