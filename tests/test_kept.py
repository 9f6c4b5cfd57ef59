"""Presence tables, profiles, schemas, archives, balanced reads, groups by batches, models."""

import json
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortwatch.functions.templates import Context, render, render_text
from cohortwatch.operators import checks, drift, models, presence, profiles, transforms
from cohortwatch.plans import kept
from cohortwatch.sources import archive, readers, writers

SF = "/root/testdata/sf0.001"
DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").cache()


@pytest.mark.parametrize("minutes", [24 * 60, 60, 7])
def test_presence_answers_any_window(spark, events, minutes):
    cadence, now = timedelta(minutes=minutes), events.agg(F.max("ts")).first()[0]
    parts = [presence.presence(events.where(F.col("ts") < cut), cadence, now) for cut in (datetime(2024, 1, 9), datetime(2024, 2, 9))]  # one holds the other
    table = presence.merge_presence([*parts, presence.presence(spark.createDataFrame([(None, now), (1, None)], "user_id long, ts timestamp"), cadence, now)]).cache()
    for back, length in ((0, 1), (0, 3), (5, 17), (8, 40), (1, 4000), (9, 9000)):
        as_of, window = now - back * cadence, length * cadence
        got = {tuple(r) for r in presence.missing_fraction(table, F.lit(as_of), window, cadence, now).collect()}
        assert got == {tuple(r) for r in checks.missing_fraction(events, F.lit(as_of), window, cadence).collect()}
    roster = spark.createDataFrame([(1,), (77_777,)], "user_id long")
    assert (77_777, 1.0) in {tuple(r) for r in presence.missing_fraction(table, now, 3 * cadence, cadence, now, roster=roster).collect()}


def test_presence_before_1970_and_over_bitmap_ends(spark):
    second, start = timedelta(seconds=1), datetime(1969, 12, 31, 12)
    rows = spark.createDataFrame([(1, start + k * second) for k in (0, 1, 40_000, 40_001, 90_000)], "user_id long, ts timestamp")
    table = presence.presence(rows, second, start)
    assert table.count() >= 3
    for last, length in ((90_000, 90_001), (40_001, 2), (40_000, 40_000), (32_767, 32_768)):
        n = sum(last - length < k <= last for k in (0, 1, 40_000, 40_001, 90_000))
        got = presence.missing_fraction(table, start + last * second, length * second, second, start).first().missing_fraction
        assert abs(got - (1 - n / length)) < 1e-12


def test_presence_rows_are_narrow_and_merged_by_hash(spark, events):
    """No wide bitmap is sorted or sent: a row is a few longs, whatever the spread of the times."""
    now = events.agg(F.max("ts")).first()[0]
    table = presence.merge_presence([presence.presence(events.where(half), timedelta(days=1), now) for half in ("event_id % 2 = 0", "event_id % 2 = 1")])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
    assert dict(table.dtypes)["bitmap"] == "bigint"


def test_presence_windows_over_the_ends_of_a_bitmap(spark):
    """Windows that end two buckets and more before the origin, over whole bitmaps and their first and last bits; with a threshold."""
    second, start = timedelta(seconds=1), datetime(2024, 1, 1)
    here = {-129, -128, -65, -64, -63, -2, -1, 0}
    table = presence.presence(spark.createDataFrame([(1, start + k * second) for k in here], "user_id long, ts timestamp"), second, start)
    assert table.count() == 4
    for last, length in ((-2, 5), (-2, 126), (-1, 64), (-2, 63), (-63, 3), (-64, 65), (-65, 64), (-128, 1), (0, 130), (-129, 64), (-10, 20)):
        n = sum(last - length < k <= last for k in here)
        got = presence.missing_fraction(table, start + last * second, length * second, second, start).first().missing_fraction
        assert abs(got - (1 - n / length)) < 1e-12, (last, length)
    assert presence.missing_fraction(table, start - 2 * second, 5 * second, second, start, threshold=0.9).count() == 0


def test_merged_profiles_equal_direct_ones(events):
    direct = profiles.merge_profiles(profiles.daily_profiles(events.withColumn("ts", F.lit("2024-01-01")), ["value"], ["user_id", "event_id"], {"value": (0, 100)}, "event_type"))
    merged = profiles.merge_profiles(profiles.daily_profiles(events, ["value"], ["user_id", "event_id"], {"value": (0, 100)}, "event_type"))
    show = lambda p: {r.topic: r for r in p.select("topic", "n_rows", "null_value", "out_value", *[profiles.distinct(k).alias(k) for k in ("user_id", "event_id")], *[profiles.quantile("value", q).alias(f"q{k}") for k, q in enumerate((0.1, 0.5, 0.9))]).collect()}
    a, b = show(direct), show(merged)
    for r in events.groupBy("event_type").agg(F.sort_array(F.collect_list("value")).alias("values"), F.countDistinct("user_id").alias("users"), F.count_if(F.expr("value not between 0 and 100")).alias("out")).collect():
        for found in (a[r.event_type], b[r.event_type]):
            assert (found.n_rows, found.out_value, found.null_value) == (len(r["values"]), r.out, 0)
            assert abs(found.user_id - r.users) <= 1 + 0.06 * r.users and abs(found.event_id - len(r["values"])) <= 1 + 0.06 * len(r["values"])
            for k, q in enumerate((0.1, 0.5, 0.9)):
                assert abs(np.searchsorted(r["values"], found[f"q{k}"]) - q * len(r["values"])) <= 0.03 * len(r["values"]) + 1
    assert profiles.merge_profiles(merged.withColumn("day", F.lit(None)), ["day"]).count() == 1
    assert profiles.fractions(merged).where("metric = 'null'").count() == 5


def test_profiles_of_odd_rows(spark):
    rows = spark.createDataFrame([("t", None, None, None), ("t", datetime(2024, 1, 1), float("nan"), "x"), (None, datetime(2024, 1, 1), 3.0, None)], "topic string, ts timestamp, v double, k string")
    found = profiles.daily_profiles(rows, ["v", "k"], ["k"])
    assert {(r.topic, str(r.day), r.n_rows, r.null_v, r.null_k) for r in found.collect()} == {("t", "None", 1, 1, 1), ("t", "2024-01-01", 1, 0, 0), (None, "2024-01-01", 1, 0, 1)}
    assert profiles.daily_profiles(rows.limit(0), ["v"], ["k"]).count() == 0


def test_fields_and_drift(spark):
    read = lambda rows: drift.topic_fields(readers.decode_any(spark.createDataFrame(rows, "topic string, value string")))
    before = read([("t", '{"a":1,"b":{"c":1},"v":null}'), ("t", '{"a":2,"w":1}'), ("t", "[1,2]"), ("t", "7"), ("t", None), ("t", "{oops"), (None, '{"x":1}')])
    assert {tuple(r) for r in before.collect()} == {("t", "a", "BIGINT", 2), ("t", "b", "OBJECT<c: BIGINT>", 1), ("t", "v", "VOID", 1), ("t", "w", "BIGINT", 1), (None, "x", "BIGINT", 1)}
    after = read([("t", '{"a":"s","b":{"c":1},"v":4,"new":true}'), (None, '{"x":2}'), ("u", '{"y":1}')])
    assert {(r.topic, r.field, r.change) for r in drift.drift(before, after).collect()} == {("t", "a", "changed"), ("t", "w", "lost"), ("t", "new", "added"), ("u", "y", "added")}
    assert drift.drift(before, before).count() == 0 and drift.drift(before.limit(0), before.limit(0)).count() == 0


def test_variant_values_keep_their_types(spark):
    rows = spark.createDataFrame([('{"a":{"n":5,"s":"x","l":[1,"b"],"t":true,"z":null}}',), ('{"a":{"n":"five"}}',), ("[]",)], "text string").select(F.parse_json("text").alias("payload"))
    settings = {"n": "{{ a.n }}", "s": "{{ a.s }}", "l": "{{ a.l }}", "first": "{{ a.l.0 }}", "t": "{{ a.t }}", "z": "{{ a.z }}", "text": "<{{ a.n }}{{ a.l }}{{ a.z }}>"}
    got = [json.loads(r[0]) for r in rows.select(F.to_json(render(settings, Context(variant="payload", keep_text=True)), {"ignoreNullFields": "false"})).collect()]
    assert got[0] == {"n": 5, "s": "x", "l": [1, "b"], "first": 1, "t": True, "z": None, "text": '<5[1,"b"]>'}
    assert got[1] == {k: "five" if k == "n" else f"{{{{ a.{k} }}}}" if k != "first" else "{{ a.l.0 }}" for k in settings} | {"text": "<five>"}
    assert got[2]["n"] == "{{ a.n }}" and got[2]["text"] == "<>"
    typed = rows.select("payload", F.lit(None).cast("int").alias("i"), F.array(F.lit(1)).alias("l"))
    keep = Context(typed.schema, keep_text=True)
    got = json.loads(typed.select(F.to_json(render({"i": "{{ i }}", "l": "{{ l }}", "p": "{{ payload.a.n }}"}, keep))).first()[0])
    assert got == {"i": "{{ i }}", "l": [1], "p": 5}
    assert typed.select(render_text("{{ i }}", Context(typed.schema))).first()[0] is None


def test_balanced_reads_of_skewed_times(spark):
    url, start = "jdbc:derby:memory:balanced;create=true", datetime(2020, 1, 1)
    rows = [(k, start + timedelta(microseconds=1000 * k) if k < 3800 else start + timedelta(days=k % 400)) for k in range(4000)] + [(5000, None)]
    writers.write_table(spark.createDataFrame(rows, "id int, at timestamp").withColumn("day", F.to_date("at")).withColumn("same", F.lit(3)).coalesce(1), url, "SKEWED", **DERBY)
    for column, kind in (('"at"', "time"), ('"id"', "number"), ('"same"', "one value"), ('"day"', "date")):
        df = readers.read_table_balanced(spark, url, "SKEWED", column, 5, **DERBY)
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert df.count() == 4001 and df.select("id").distinct().count() == 4001, kind
        if kind in ("time", "number"):
            full = sorted(s for s in sizes if s > 1)
            assert 4 <= len(full) <= 7 and max(full) <= 2 * full[len(full) // 2], (kind, sizes)
    writers.write_table(spark.createDataFrame([], "id int"), url, "EMPTY_ONE", **DERBY)
    both = readers.read_tables(spark, url, {"EMPTY_ONE": '"id"', "SKEWED": None}, **DERBY)
    assert both["EMPTY_ONE"].count() == 0 and both["SKEWED"].count() == 4001 and readers.read_tables(spark, url, ["SKEWED"], **DERBY)["SKEWED"].count() == 4001


def test_balanced_table_of_large_and_absent_ids(spark, tmp_path):
    ids = [3 * 10**15 * k for k in range(3001)] + [None]
    rows = spark.createDataFrame([(n, k / 2) for k, n in enumerate(ids)], "event_id long, value double")
    rows.withColumn("ts", F.lit(datetime(2024, 1, 1))).write.parquet(f"{tmp_path}/events.parquet")
    got = kept.balanced_table(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [(n, k / 2) for k, n in enumerate(ids)]
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    full = sorted(s for s in sizes if s > 1)
    assert 3 <= len(full) <= 6 and max(full) <= 2 * full[len(full) // 2], sizes


def test_pulls_by_offset_ranges(spark, tmp_path, monkeypatch):
    def add(rows):
        spark.createDataFrame(rows, "topic string, partition int, offset long, value string").write.mode("append").partitionBy("topic").parquet(str(tmp_path / "in"))
        return spark.read.parquet(str(tmp_path / "in"))

    out, kept = str(tmp_path / "out"), str(tmp_path / "positions")
    got = lambda: sorted((r.topic, r.partition, r.offset) for r in spark.read.parquet(out).collect())
    first = [(t, p, o, "x") for t in ("a", "b") for p in (0, 1) for o in range(10, 30)]
    messages = add(first)
    assert archive.pull(messages, out, kept, topics=["a"], most=25) == 0
    assert got() == [("a", 0, o) for o in range(10, 30)] + [("a", 1, o) for o in range(10, 15)]
    messages = add([("a", 1, o, "y") for o in range(30, 33)] + [("c", 0, 0, "y")])
    assert archive.pull(messages, out, kept) == 1 and archive.pull(messages, out, kept) == -1
    everything = sorted((r.topic, r.partition, r.offset) for r in messages.collect())
    assert got() == everything
    # A pull whose positions were not written is done again under its number.
    messages = add([("b", 0, o, "z") for o in range(30, 40)])
    wanted = archive.ranges(messages, archive.positions(spark, kept))
    archive.read_ranges(messages, wanted).write.parquet(f"{out}/pull=2")
    assert archive.pull(messages, out, kept) == 2 and got() == sorted((r.topic, r.partition, r.offset) for r in messages.collect())
    plan = archive.read_ranges(messages, archive.ranges(messages))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or" in plan and "PartitionFilters: [" in plan
    monkeypatch.setattr(archive, "PREDICATES", 1)
    assert archive.read_ranges(messages, archive.ranges(messages)).count() == messages.count()
    assert archive.read_ranges(messages, archive.ranges(messages).limit(0)).count() == 0


def test_a_large_group_comes_in_batches(spark):
    rows = spark.range(1_000_000).selectExpr("if(id % 1000 = 0, 2, 1) as g", "id")

    def sizes(batches):
        most = n = 0
        for b in batches:
            most, n, g = max(most, len(b)), n + len(b), b["g"].iloc[0]
        yield pd.DataFrame({"g": [g], "n": [n], "most": [most]})

    got = {r.g: r for r in transforms.custom_by_batches(rows, "g", sizes, "g int, n long, most long").collect()}
    assert (got[1].n, got[2].n) == (999_000, 1000) and got[1].most <= int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def test_loaded_models(spark, tmp_path):
    (tmp_path / "model.json").write_text(json.dumps({"w": [2.0, -1.0]}))

    def load(content):
        weights = np.array(json.loads(content)["w"])
        return lambda values: values @ weights

    rows = spark.createDataFrame([(1, 2.0, 1.0), (2, None, 1.0), (3, 0.0, 5.0)], "id long, a double, b double").withColumn("score", F.lit("own"))
    got = {r.id: (r.score, r.is_anomaly) for r in models.score_loaded(rows, str(tmp_path / "model.json"), load, ["a", "b"], 1.0).collect()}
    assert got == {1: (3.0, True), 2: (None, None), 3: (-5.0, False)}
    assert models.score_loaded(rows.limit(0), str(tmp_path / "model.json"), load, ["a", "b"]).count() == 0


def test_held_out_accuracy(spark, tmp_path):
    rows = spark.createDataFrame([(k, (k * 37 % 101) / 10, (k * 53 % 103) / 10, float((k * 37 % 101) > (k * 53 % 103))) for k in range(4000)], "id long, a double, b double, label double")
    learnt, held_out = models.split(rows, ["id"])
    assert learnt.count() + held_out.count() == 4000 and 800 < held_out.count() < 1200
    model = models.train(learnt, ["a", "b"], "label", hidden=())
    found = models.accuracy(models.score(held_out, model, 0.5), "label").first()
    assert found.n == held_out.count() and found.n_right >= 0.97 * found.n > 0.97 * found.n_most
    model.write().overwrite().save(str(tmp_path / "m"))
    assert models.accuracy(models.score(held_out, str(tmp_path / "m"), 0.5), "label").first() == found
