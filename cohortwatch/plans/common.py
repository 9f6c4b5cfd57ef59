"""What the ready-made queries share: the event table, its newest time, and events as messages."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = timedelta(days=1)


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def newest(events: DataFrame):
    """The newest event's time as a scalar subquery: no job runs until the query does."""
    return events.agg(F.max("ts")).scalar()


def as_messages(events: DataFrame, value: str = "props") -> DataFrame:
    """The events as a topic's messages, the type as topic."""
    return events.select(F.col("user_id").cast("string").cast("binary").alias("key"), F.col(value).cast("binary").alias("value"), F.col("event_type").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"), F.lit(0).alias("timestampType"))
