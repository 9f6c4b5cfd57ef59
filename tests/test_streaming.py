from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cohortwatch.operators import checks, transforms
from cohortwatch.sources import readers
from cohortwatch.streaming import monitor

SF = "/root/testdata/sf0.001"


def in_time_order(spark, path, parts=3):
    """The events as one file after another, in event order; a streaming read of them, one a batch."""
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    n = events.count()
    ranked = events.orderBy("ts", "event_id").toPandas()
    for k in range(parts):
        part = ranked.iloc[k * n // parts : (k + 1) * n // parts]
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(path)
    return events, spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(stream, name, tmp_path):
    q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def test_silence_agrees_with_the_batch_check(spark, tmp_path):
    events, stream = in_time_order(spark, str(tmp_path / "in"))
    got = run(monitor.silent_participants(stream, timedelta(days=1)), "silent", tmp_path)
    newest = events.agg(F.max("ts")).first()[0]
    want = {r.user_id for r in checks.missing_participants(events, F.lit(newest), timedelta(days=1)).collect()}
    last = {r.user_id: r.t for r in events.groupBy("user_id").agg(F.max("ts").alias("t")).collect()}
    final = {r.user_id for r in got.collect() if abs((r.last_seen - last[r.user_id]).total_seconds()) < 0.01}
    assert final == want and want


def test_repeats_are_dropped(spark, tmp_path):
    events, _ = in_time_order(spark, str(tmp_path / "in"), 1)
    spark.read.parquet(str(tmp_path / "in")).where("event_id % 10 = 0").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    assert run(monitor.without_repeats(stream, ["event_id"], "40 days"), "once", tmp_path).count() == events.count()


def test_reports_are_written_once_a_batch(spark, tmp_path):
    _, stream = in_time_order(spark, str(tmp_path / "in"), 2)
    out = str(tmp_path / "out")
    sink = monitor.write_once(out)

    def twice(rows, batch_id):  # as after a failure
        sink(rows, batch_id)
        sink(rows, batch_id)

    q = monitor.emit(stream, lambda rows: transforms.spikes_by_user(rows, "value", 200), twice, str(tmp_path / "cp"))
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.agg(F.sum("n_spikes")).first()[0] == spark.read.parquet(f"{SF}/events.parquet").where("value > 200").count()
    assert got.select("batch_id").distinct().count() == 2


def test_incremental_pull(spark, tmp_path):
    events, stream = in_time_order(spark, str(tmp_path / "in"), 3)
    for _ in range(2):  # the second finds nothing new
        monitor.pull(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()


def test_stream_decoding(spark, tmp_path):
    (tmp_path / "m").mkdir()
    spark.createDataFrame([(b'{"k": 1}', "t"), (b"junk", "t")], "value binary, topic string").write.mode("append").parquet(str(tmp_path / "m"))
    from cohortwatch.sources import schemas

    stream = spark.readStream.schema("value binary, topic string").parquet(str(tmp_path / "m"))
    good, _ = readers.split_corrupt(readers.decode(stream, schemas.struct(k=schemas.INT)))
    assert [tuple(r) for r in run(good, "decoded", tmp_path).collect()] == [("t", 1)]


def test_console(spark, tmp_path):
    from cohortwatch.sources import writers

    events, stream = in_time_order(spark, str(tmp_path / "in"), 1)
    query = writers.to_console(stream.select("event_id"), rows=2)
    query.processAllAvailable()
    done = query.recentProgress
    query.stop()
    assert sum(p["numInputRows"] for p in done) == events.count() and "console" in done[0]["sink"]["description"].lower()


def deliveries(events, path, cuts):
    """One delivery after another of the events between the cuts."""
    for a, b in zip(cuts, cuts[1:]):
        events.where((F.col("ts") >= a) & (F.col("ts") < b)).write.mode("append").parquet(path)
        yield b


def test_roster_silence_agrees_with_the_batch_check_after_each_delivery(spark, tmp_path):
    """Members who never send, fall silent, come back, and others who are no members."""
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    ids = [r.user_id for r in events.select("user_id").distinct().orderBy("user_id").collect()]
    members = [*ids[: len(ids) // 2], 10_001, 10_002]
    roster = spark.createDataFrame([(k, first) for k in members] + [(None, first), (10_001, first)], "user_id long, since timestamp")
    window, cuts = timedelta(hours=12), [first + (last - first) * k / 3 for k in range(3)] + [last + timedelta(days=1)]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for end in deliveries(events, path, cuts):
        found = monitor.roster_silence(spark.readStream.schema(events.schema).parquet(path), roster, window)
        monitor.pull(found, out, str(tmp_path / "cp")).awaitTermination()
        changes = spark.read.parquet(out)
        got = {(r.user_id, r.last_seen) for r in monitor.silent_now(changes).collect()}
        so_far = events.where(F.col("ts") < end)
        newest = so_far.agg(F.max("ts")).first()[0]
        want = {(r.user_id, r.last_seen) for r in checks.missing_participants(so_far, F.lit(newest), window, roster).collect()}
        assert got == want and (10_001, None) in got and any(t for _, t in got)
    kinds = {(r.user_id, r.silent) for r in changes.collect()}
    assert any((k, False) in kinds for k in ids) and {k for k, _ in kinds} <= set(members)


def test_backoff_state_agrees_with_a_walk_over_the_findings(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = sorted((k % 7, start + timedelta(hours=(k * 37) % 400), f"n{k}") for k in range(300))
    rows += [(None, start, "x")]
    df = spark.createDataFrame(rows, "user_id long, found_at timestamp, _note string")
    path, out, backoff = str(tmp_path / "in"), str(tmp_path / "out"), timedelta(hours=30)
    for k in range(3):
        df.where((F.col("found_at") >= start + timedelta(hours=140 * k)) & (F.col("found_at") < start + timedelta(hours=140 * (k + 1)))).write.mode("append").parquet(path)
        stream = monitor.with_backoff(spark.readStream.schema(df.schema).parquet(path), backoff)
        assert stream.columns == df.columns
        monitor.pull(stream, out, str(tmp_path / "cp")).awaitTermination()
    want, last = set(), {}
    for user, at, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[1]):
        if user not in last or at >= last[user] + backoff:
            last[user] = at
            want.add((user, at))
    assert {(r.user_id, r.found_at) for r in spark.read.parquet(out).collect()} == want


def test_roster_state_is_a_value_for_each_block(spark, tmp_path):
    """Blocks that come in several parts, ids that are text, a member who is heard again, a timer at the watermark itself."""
    start, day = datetime(2024, 1, 1), timedelta(days=1)
    roster = spark.range(25_000).select(F.concat(F.lit("m"), "id").alias("user_id"), F.lit(start).alias("since"))
    kinds = "user_id string, ts timestamp"
    deliveries = [[("m1", start), ("m2", start + day), ("x", start + day), (None, start)], [("m1", start + 1.5 * day), ("m2", start + 2.5 * day)], [("m1", start + 3 * day)]]
    path, out, states = str(tmp_path / "in"), str(tmp_path / "out"), []
    for rows in deliveries:
        spark.createDataFrame(rows, kinds).write.mode("append").parquet(path)
        found = monitor.roster_silence(spark.readStream.schema(kinds).parquet(path), roster, day, blocks=2)
        query = monitor.pull(found, out, str(tmp_path / "cp"))
        query.awaitTermination()
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    changes = spark.read.parquet(out)
    assert max(states) <= 2
    assert changes.count() == 24_998 + 4
    own = sorted((r.changed_at, r.user_id, r.silent, r.last_seen) for r in changes.where("user_id in ('m1', 'm2', 'x')").collect())
    ends = [(start + k * day, silent, start + last * day) for k, silent, last in ((1, True, 0), (1.5, False, 1.5), (2.5, True, 1.5), (3, False, 3))]
    assert own == [(at, "m1", silent, last) for at, silent, last in ends]
    assert {tuple(r) for r in changes.where("user_id = 'm3'").collect()} == {("m3", None, True, start + day)}
    events = spark.read.schema(kinds).parquet(path)
    want = {tuple(r) for r in checks.missing_participants(events, F.lit(start + 3 * day), day, roster).collect()}
    assert {tuple(r) for r in monitor.silent_now(changes).collect()} == want and len(want) == 24_998


def test_silence_state_is_a_value_for_each_block(spark, tmp_path):
    start, day, kinds = datetime(2024, 1, 1), timedelta(days=1), "user_id string, ts timestamp"
    path, out, states = str(tmp_path / "in"), str(tmp_path / "out"), []
    spark.range(500).select(F.concat(F.lit("m"), "id").alias("user_id"), F.lit(start).alias("ts")).write.parquet(path)
    for rows in ([], [("m1", start + 0.5 * day)], [("m2", start + 1 * day)]):
        spark.createDataFrame(rows, kinds).write.mode("append").parquet(path)
        query = monitor.pull(monitor.silent_participants(spark.readStream.schema(kinds).parquet(path), day, blocks=2), out, str(tmp_path / "cp"))
        query.awaitTermination()
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r.user_id, r.last_seen) for r in spark.read.parquet(out).collect())
    assert got == sorted((f"m{k}", start) for k in range(500) if k not in (1, 2)) and max(states) <= 2
