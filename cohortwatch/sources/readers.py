"""Sources: bounded and unbounded topic reads, JSON decoding, CSV files, relational tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


def topic_names(topics: str | Iterable[str]) -> list[str]:
    """A topic or several as a list; none at all is an error."""
    names = [topics] if isinstance(topics, str) else list(topics)
    if not names or not all(names):
        raise ValueError("at least one topic is needed")
    return names


def kafka_options(servers: str, topics: str | Iterable[str], starting: str = "earliest", ending: str | None = None, since: datetime | None = None, max_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """The Kafka source's options; ``since`` bounds the scan by message time, which no filter would."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topic_names(topics)), "startingOffsets": starting}
    if since is not None:
        del options["startingOffsets"]
        options["startingTimestamp"] = str(int(since.timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if ending is not None:
        options["endingOffsets"] = ending
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options | extra


def read_topics(spark: SparkSession, servers: str, topics: str | Iterable[str], ending: str = "latest", **options) -> DataFrame:
    """One bounded read of one or several topics; ``topic`` tells them apart."""
    return spark.read.format("kafka").options(**kafka_options(servers, topics, ending=ending, **options)).load()


def stream_topics(spark: SparkSession, servers: str, topics: str | Iterable[str], starting: str = "latest", **options) -> DataFrame:
    """An unbounded read. With ``max_per_trigger`` and an availableNow trigger it is an incremental pull: all that is there, in bounded batches."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, starting, **options)).load()


def shown(messages: DataFrame) -> DataFrame:
    """Topic, partition, offset, key and value of messages as text."""
    return messages.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def drop_tombstones(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages with a value."""
    return messages.where(F.col(value_col).isNotNull())


def decode(messages: DataFrame, schema: StructType, value_col: str = "value", keep: Iterable[str] = ("topic",)) -> DataFrame:
    """Typed decoding of JSON values: the envelope's ``keep``, the payload's columns, and ``_corrupt``.

    A kept column of the envelope with the name of a field of the payload becomes ``message_`` and its name.
    Tombstones are dropped. ``_corrupt`` holds the text of what is no JSON object of these types, else
    NULL; malformed text alone would decode to a row of NULLs.
    """
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    kept = [c for c in keep if c in messages.columns]
    rows = drop_tombstones(messages, value_col).select(*kept, text.alias("_text"), parsed.alias("_parsed"))
    bad = F.col(f"_parsed.{CORRUPT}").isNotNull() | F.col("_parsed").isNull() | ~F.col("_text").rlike(r"^[ \t\r\n]*\{")
    fields = {f.name.lower() for f in schema.fields}
    envelope = [F.col(c).alias(f"message_{c}" if c.lower() in fields else c) for c in kept]
    return rows.select(*envelope, *[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields], F.when(bad, F.col("_text")).alias(CORRUPT))


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the quarantined ones."""
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT), decoded.where(F.col(CORRUPT).isNotNull())


def decode_any(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Untyped decoding: ``payload`` is a VARIANT of any valid JSON; tombstones and invalid text are dropped."""
    return drop_tombstones(messages, value_col).withColumn("payload", F.try_parse_json(F.col(value_col).cast("string"))).where("payload is not null")


def unite(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; columns that a frame lacks are NULL."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(spark: SparkSession, paths: Iterable[str], schema: StructType | None = None) -> DataFrame:
    """CSV files with headers, united by column name. With a schema, absent columns are NULL and others are dropped; without one, all are text."""
    frames = [spark.read.csv(p, header=True) for p in paths]
    united = unite(frames)
    if schema is None:
        return united
    return united.select(*[(F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})") if f.name in united.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, url: str, table: str, column: str | None = None, lower: str | None = None, upper: str | None = None, partitions: int = 8, **properties: str) -> DataFrame:
    """A relational table; with a partition column and its bounds it is read in parallel."""
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if lower is None or upper is None:
        raise ValueError("a partition column needs its lower and upper bound")
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, **properties).load()


def _literal(value: Decimal | int | float | date | datetime) -> str:
    """A value in SQL text; times as JDBC escapes, which every driver puts into its own form."""
    if isinstance(value, datetime):
        return f"{{ts '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'}}"
    return f"{{d '{value}'}}" if isinstance(value, date) else str(value)


def _between(low, high, parts: int) -> list:
    """Values that cut the space from ``low`` to ``high`` evenly, without repeats and ends."""
    if isinstance(low, date) and not isinstance(low, datetime):
        cuts = [low + timedelta(days=(high - low).days * k // parts) for k in range(1, parts)]
    elif isinstance(low, int):
        cuts = [low + (high - low) * k // parts for k in range(1, parts)]
    else:
        cuts = [low + (high - low) * k / parts for k in range(1, parts)]
    return sorted({c for c in cuts if low < c < high})


def balanced_predicates(spark: SparkSession, url: str, table: str, column: str, partitions: int = 8, fine: int = 8, rounds: int = 24, **properties: str) -> list[str]:
    """Predicates that cut a table into parts of near equal row counts by the values of a number, date or time column.

    The database counts its rows in ``fine * partitions`` even intervals; an interval with more than its share is
    cut again, until it is within it, holds one value, or ``rounds`` are over. Neighbouring intervals are then joined. Only
    counts come to the driver. Nulls are a part of their own, and so is a value with more than a part's rows.
    """
    read = lambda query: spark.read.format("jdbc").options(url=url, query=query, **properties).load()
    low, high, n = read(f"SELECT MIN({column}) AS low, MAX({column}) AS high, COUNT({column}) AS n FROM {table}").first()
    nulls = [f"{column} IS NULL"]
    if not n:
        return nulls
    # Intervals [a, b): start, end, rows; the end of the last is None.
    known, todo = [], [(low, None, n)]
    for _ in range(rounds):
        cut, steps = [], []
        for a, b, rows in todo:
            cuts = _between(a, high if b is None else b, fine * partitions)
            if b is None and high not in cuts and a < high:
                cuts.append(high)
            if rows * fine <= n / partitions or not cuts:
                known.append((a, b, rows))
            else:
                ends = [*cuts, b]
                case = " ".join(f"WHEN {column} < {_literal(c)} THEN {k}" for k, c in enumerate(cuts)) + f" ELSE {len(cuts)}"
                where = f"{column} >= {_literal(a)}" + ("" if b is None else f" AND {column} < {_literal(b)}")
                cut += zip([a, *cuts], ends)
                steps.append((len(cut) - len(ends), f"SELECT piece, COUNT(*) AS n FROM (SELECT CASE {case} END AS piece FROM {table} WHERE {where}) counted GROUP BY piece"))
        todo = []
        for at, query in steps:
            todo += [(*cut[at + piece], rows) for piece, rows in read(query).collect()]  # a row for each interval
        if not todo:
            break
    parts, held = [], 0
    for a, b, rows in sorted(known + todo, key=lambda x: x[0]):
        if not parts or held and held + rows / 2 > n / partitions:
            parts.append(a)
            held = 0
        held += rows
    ends = [f" AND {column} < {_literal(b)}" for b in parts[1:]] + [""]
    return [f"{column} >= {_literal(a)}{end}" for a, end in zip(parts, ends)] + nulls


def read_table_balanced(spark: SparkSession, url: str, table: str, column: str, partitions: int = 8, **properties: str) -> DataFrame:
    """A relational table read in parallel parts of near equal size, whatever the spread of ``column``."""
    return spark.read.jdbc(url, table, predicates=balanced_predicates(spark, url, table, column, partitions, **properties), properties=properties)


def read_tables(spark: SparkSession, url: str, tables: Iterable[str] | dict[str, str | None], partitions: int = 8, **properties: str) -> dict[str, DataFrame]:
    """Several tables by name; a mapping gives the column that a table is read in balanced parts by (None: in one)."""
    columns = tables if isinstance(tables, dict) else dict.fromkeys(tables)
    return {t: read_table_balanced(spark, url, t, c, partitions, **properties) if c else read_table(spark, url, t, **properties) for t, c in columns.items()}


def read_source(spark: SparkSession, kind: str, path: str | None = None, **options: str) -> DataFrame:
    """A source by its type name, looked up by Spark; an unknown one is its DATA_SOURCE_NOT_FOUND error."""
    reader = spark.read.format(kind).options(**options)
    return reader.load(path) if path else reader.load()
