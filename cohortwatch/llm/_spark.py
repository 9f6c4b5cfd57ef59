"""Small Spark helpers shared by the operators: scratch tables, guarded broadcasts, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if it is known to have no more rows than this.
BROADCAST_ROWS = 200_000
#: A key with more than this part of all rows is hot; there are fewer hot keys than this number.
HOT_KEYS = 10_000
#: Rows and bytes of an Arrow batch while scratch tables are written.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20

_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
_local: list[str] = []
_written: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``).

    Where it is unset, a temporary folder serves a session in one process; on a cluster, whose
    machines don't share such a folder, that is a ValueError.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _local:
        _local.append("file://" + tempfile.mkdtemp(prefix="cohortwatch-"))
    return _local[0]


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: lineage ends at replicated files.

    While it is written, Arrow batches hold ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes at most (or one row).
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/cohortwatch/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    before = {k: spark.conf.get(k) for k in _LIMITS}
    small_batches(spark)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def scratch_tables(spark: SparkSession) -> list[str]:
    """Paths of the scratch tables that this session has written and not dropped."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def drop_scratch(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete these tables of :func:`saved`, or all of the session's: only when no result that reads them is still to be computed."""
    own = _written.get(spark.sparkContext.applicationId, [])
    for path in [t.scratch_path for t in tables] or list(own):
        if path in own:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            own.remove(path)


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches are as small as those of scratch tables, for results that are written later."""
    for k, most in _LIMITS.items():
        now = spark.conf.get(k).rstrip("b")  # the limit of bytes ends with its unit
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(k, most)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its row count is within the bound, else as it is (shuffle join)."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def looked_up(rows: DataFrame, table: DataFrame, key: str | list[str], total: int) -> DataFrame:
    """``rows`` with the columns of ``table`` behind them, joined on ``key``, of which the table's ``n`` counts the rows.

    Keys with more than a ``HOT_KEYS``-th of the ``total`` rows are broadcast: there are fewer than
    ``HOT_KEYS`` of them. So no task of the shuffled join for the others has more of one key than that share.
    """
    hot = F.col("n") * HOT_KEYS > total
    often = F.broadcast(table.where(hot))
    if total <= HOT_KEYS:  # every key is hot
        return rows.join(often, key)
    seldom = rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti")
    return rows.join(often, key).unionByName(seldom.join(table.where(~hot), key))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_1, name_2, … that is no column of ``df`` (case ignored)."""
    taken, k, found = {c.lower() for c in df.columns}, 0, name
    while found.lower() in taken:
        k += 1
        found = f"{name}_{k}"
    return found


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(id, component)``, the component's smallest id.

    Every vertex that occurs in an edge gets a row; self-loops and repeated edges are fine. Each
    round links the larger neighbours of a vertex to its smallest (large star), then the smaller
    ones (small star); the rounds grow with the logarithm of the graph, and each writes its edges
    to the shared folder. A vertex of high degree is only ever aggregated with map-side minima
    and looked up as a hot key, never collected.
    """
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    loops = edges.where("a = b").select(F.col("a").alias("id")).distinct()
    while True:
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(e.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up > 0 and down > 0").isEmpty():
            break  # stars: every larger end has one edge and is no smaller end
        n = 2 * e.count()
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = looked_up(both.where("v > u"), low, "u", n).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "edges")
        drop_scratch(e.sparkSession, e)
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        star = looked_up(large, low, "u", n).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = saved(star.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        drop_scratch(e.sparkSession, large)
    ends = e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("id"), F.col("v").alias("component")))
    return ends.unionAll(loops.select("id", F.col("id").alias("component"))).groupBy("id").agg(F.min("component").alias("component"))
