import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortwatch.functions.templates import Context, action_time, render, render_text
from cohortwatch.operators import actions, checks, conditions, models, transforms
from cohortwatch.sources.readers import CORRUPT

NOW = datetime(2024, 1, 10, 12)
HOUR = timedelta(hours=1)


@pytest.fixture(scope="module")
def events(spark):
    rows = [("a", NOW, 1.0), ("a", NOW - 30 * HOUR, 250.0), ("b", NOW - 24 * HOUR, 5.0), ("c", NOW - 23 * HOUR, None), ("d", NOW + HOUR, 300.0), (None, NOW, 1.0), ("e", None, 1.0)]
    return spark.createDataFrame(rows, "user_id string, ts timestamp, value double")


def ids(df):
    return sorted(r.user_id for r in df.collect())


def test_missing_participants(events, spark):
    assert ids(checks.missing_participants(events, NOW, timedelta(days=1))) == ["b", "d", "e"]
    roster = spark.createDataFrame([("a",), ("z",), (None,)], "user_id string")
    got = checks.missing_participants(events, NOW, "1 day", roster).collect()
    assert [(r.user_id, r.last_seen) for r in got] == [("z", None)]
    assert checks.missing_participants(events.limit(0), NOW, "1 day").count() == 0


def test_missing_fraction(events):
    got = {r.user_id: r.missing_fraction for r in checks.missing_fraction(events, NOW, timedelta(days=3), timedelta(days=1)).collect()}
    assert got == {"a": pytest.approx(1 / 3), "b": pytest.approx(2 / 3), "c": pytest.approx(2 / 3), "d": 1.0, "e": 1.0}
    assert ids(checks.missing_fraction(events, NOW, timedelta(days=3), timedelta(days=1), 1.0)) == ["d", "e"]
    with pytest.raises(ValueError):
        checks.missing_fraction(events, NOW, HOUR, 2 * HOUR)


def test_recency_keeps_the_near_future_only(spark):
    rows = spark.createDataFrame([(NOW + timedelta(minutes=14),), (NOW + timedelta(minutes=16),), (NOW - 999 * HOUR,), (None,)], "ts timestamp")
    assert transforms.recent(rows, "ts", NOW).count() == 2


def test_backoff(spark):
    found = spark.createDataFrame([("a",), ("b",), ("c",)], "user_id string")
    log = spark.createDataFrame([("x", "a", NOW - 47 * HOUR), ("x", "b", NOW - 48 * HOUR), ("x", "c", NOW + HOUR)], "action string, user_id string, alerted_at timestamp")
    assert ids(checks.without_recent_alerts(found, log, NOW, "2 days")) == ["b", "c"]
    assert checks.alert_log(found, "x", NOW).columns == log.columns


def test_quality(spark):
    rows = spark.createDataFrame([(1, 5.0), (1, None), (2, 50.0), (3, 7.0)], "id int, v double")
    got = {(r.metric, r.column): r.fraction for r in checks.quality_metrics(rows, ["v"], {"v": (0, 10)}, ["id"]).collect()}
    assert got == {("null", "v"): 0.25, ("out_of_range", "v"): 0.25, ("duplicate", "id"): 0.25}
    empty = checks.quality_metrics(rows.limit(0), ["v"], {"v": (0, 10)}, ["id"])
    assert {r.fraction for r in empty.collect()} == {0.0} and checks.quality_metrics(rows, ["id"], threshold=0.1).count() == 0


def test_schema_violations(spark):
    rows = spark.createDataFrame([("t", "u", None), ("t", None, None), ("t", None, "junk")], f"topic string, user_id string, {CORRUPT} string")
    got = {(r.topic, r.reason): r.n for r in checks.schema_violations(rows, ["user_id"]).collect()}
    assert got == {("t", "null user_id"): 1, ("t", "corrupt"): 1}


def test_spikes_and_lists(events, spark):
    assert [(r.user_id, r.n_spikes, r.max_value) for r in transforms.spikes_by_user(events, "value", 200).orderBy("user_id").collect()] == [("a", 1, 250.0), ("d", 1, 300.0)]
    assert transforms.flag_spikes(events, "value", 200).where("is_anomaly is null").count() == 0
    assert transforms.participant_list(events).first()[0] == ["a", "b", "c", "d", "e"]
    assert transforms.participant_list(events, distinct=False).first()[0] == ["a", "a", "b", "c", "d", "e"]
    assert transforms.participant_list(events.limit(0)).first()[0] == []


def test_parse_clean_and_cap(spark):
    text = spark.createDataFrame([("2024-01-01T12:00:00.123456",), ("2024-01-01T12:00:00Z",), ("xx",), (None,)], "timestamp string")
    got = [r[0] for r in transforms.parse_time(text).collect()]
    assert got[:2] == [datetime(2024, 1, 1, 12, 0, 0, 123456), datetime(2024, 1, 1, 12)] and got[2:] == [None, None]
    rows = spark.createDataFrame([(1, 5.0), (1, 5.0), (None, 5.0), (2, 500.0), (3, None)], "id int, v double")
    assert [tuple(r) for r in transforms.clean(rows, ["id"], {"v": (0, 200)}).collect()] == [(1, 5.0)]
    capped = transforms.cap_per_group(spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "topic string, n int"), 2, "topic", ["n"])
    assert sorted(map(tuple, capped.collect())) == [("a", 0), ("a", 1), ("b", 9)]


def test_custom_by_group(spark):
    got = transforms.custom_by_group(spark.range(6).selectExpr("id % 2 as k", "id"), "k", lambda g: g.head(1), "k long, id long")
    assert sorted(map(tuple, got.collect())) == [(0, 0), (1, 1)]


@pytest.fixture(scope="module")
def context(spark):
    one = spark.createDataFrame([(["u1", "u2"], [3, None], True, None)], "ids array<string>, ns array<int>, ok boolean, none string")
    return actions.gather({"a": one})


def value(context, template):
    return context.select(render_text(template, Context(context.schema)).alias("v")).first().v


def test_templates(context):
    assert value(context, "{{ a.ids }}") == ["u1", "u2"]
    assert value(context, "ids: {{ a.ids }}, {{a.ns}} {{ a.ok }}") == "ids: ['u1', 'u2'], [3, None] True"
    assert value(context, "{{ a.ids.1 }}") == "u2" and value(context, "{{ a.ids.7 }}") == "{{ a.ids.7 }}" and value(context, "{{ a.none }}") == "{{ a.none }}"
    assert value(context, "{{ a.ns.1 }}") is None  # no text fits an int column
    assert value(context, "x {{ a.zz }} y{{ a.none }}") == "x  y" and value(context, "{{ a.zz }}") == "{{ a.zz }}" and value(context, "plain") == "plain"
    got = context.select(render({"k": [{"m": "{{ a.ids.0 }}!"}, 5], "n": None, "l": ["x", "y {{ a.ok }}"], "e": {}, "f": []}, Context(context.schema)).alias("v")).first().v
    assert [json.loads(x.toJson()) if hasattr(x, "toJson") else x for x in got.k] == [{"m": "u1!"}, 5] and got.n is None and got.l == ["x", "y True"] and got.e == {} and got.f == []
    text = lambda v: json.loads(context.select(F.to_json(F.struct(render(v, Context(context.schema)).alias("v")))).first()[0])["v"]
    assert text(["{{ a.ids.0 }}", "x"]) == ["u1", "x"] and text([{"k": "{{ a.ids.0 }}"}, {"k": "b"}]) == [{"k": "u1"}, {"k": "b"}]
    assert text(["{{ a.ids }}", 1, True, {"z": [1.5]}]) == [["u1", "u2"], 1, True, {"z": [1.5]}] and text([[1, 2], [3]]) == [[1, 2], [3]]


def test_variant_context(spark):
    rows = spark.sql("""select parse_json('{"a": {"ids": ["u1"], "n": 2}}') as v""")
    look = lambda t: rows.select(render_text(t, Context(variant="v")).alias("r")).first().r
    assert look("{{ a.ids.0 }}") == "u1" and look("n={{ a.n }}{{ a.x }}") == "n=2" and look("{{ a.x }}") == "{{ a.x }}"
    with pytest.raises(ValueError):
        Context()


def test_conditions(context):
    for rule, holds in (("size(a.ids) > 0", True), ("a.ids <> array()", True), ("a.none = 'x'", False), (None, True), (["a.ok", "size(a.ids) = 2"], True), (["a.ok", "false"], False), ([], True), (F.lit(None).cast("boolean"), False)):
        assert conditions.gate(context, rule).count() == holds, rule
    assert conditions.holds_for_any(context, "false").first().holds is False


def test_action_times(spark):
    at = lambda w: spark.range(1).select(action_time(w, F.lit(NOW)).alias("t")).first().t
    assert at("immediate") is None and at(None) is None and at("garbage") is None
    assert at("8:30pm") == at("8:30 PM") == at("20:30") == datetime(2024, 1, 10, 20, 30)
    assert at("8:30:15") == datetime(2024, 1, 10, 8, 30, 15) and at("8:30:15 pm") == datetime(2024, 1, 10, 20, 30, 15)
    assert at("Jan 5 2024 8:30") == at("5 January 2024 8:30am") == at("2024/1/5 8:30") == datetime(2024, 1, 5, 8, 30) and at("1/5/2024") == datetime(2024, 1, 5)
    assert at("2024-05-01T01:02:03") == datetime(2024, 5, 1, 1, 2, 3) and at(timedelta(minutes=5)) == NOW + timedelta(minutes=5)


def test_reports(context, spark):
    two = [actions.Action("notify", "send", "size(a.ids) > 0", settings={"message": "for {{ a.ids }}"}), actions.Action("later", "ask", when="8:30pm", settings=[]), actions.Action("never", rule="false")]
    got = {r.name: json.loads(r.value) for r in actions.report_messages(context, two, F.lit(NOW)).collect()}
    assert set(got) == {"notify", "later"}
    assert got["notify"]["metadata"] == {"message": "for ['u1', 'u2']"} and got["notify"]["time"] is None and got["notify"]["data"]["a"]["ids"] == ["u1", "u2"]
    assert got["later"]["metadata"] == {} and got["later"]["time"].startswith("2024-01-10T20:30")
    with pytest.raises(ValueError):
        actions.gather({})
    for n in (0, 2):
        with pytest.raises(Exception, match=f"users has not one row but {n}"):
            actions.gather({"users": spark.range(n)}).collect()
    plan = actions.report_messages(context, two, F.lit(NOW))._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_one_scan_without_a_roster(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    now = events.agg(F.max("ts")).first()[0]
    for found in (checks.missing_participants(events, F.lit(now), timedelta(days=1)), checks.missing_fraction(events, F.lit(now), timedelta(days=3), timedelta(days=1))):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation") == 1 and "Join" not in plan


def test_alert_rows(spark):
    found = spark.createDataFrame([("u1", 3)], "user_id string, n int")
    r = actions.alert_rows(found, "high", "email", F.lit(NOW), recipients=["x"], subject="{{ user_id }}", body="{{ n }} times").first()
    assert (r.action, r.method, r.user_id, r.subject, r.body, r.recipients, r.due_at, r.alerted_at) == ("high", "email", "u1", "u1", "3 times", ["x"], None, NOW)
    assert actions.alert_rows(found.limit(0), "a", "b").count() == 0


def test_models(spark, tmp_path):
    rows = spark.createDataFrame([(float(i), float(i % 7), float(i >= 50)) for i in range(100)] + [(None, 1.0, 1.0)], "x double, y double, label double")
    model = models.train(rows, ["x", "y"], "label", hidden=[])
    model.write().overwrite().save(f"file://{tmp_path}/m")
    got = models.score(rows.drop("label"), f"file://{tmp_path}/m", 0.5)
    assert got.count() == 101 and got.where("x is null and score is null and is_anomaly is null").count() == 1
    assert got.where("is_anomaly = (x >= 50)").count() >= 95
    clash = rows.selectExpr("x", "y", "'f' as features", "'p' as probability", "1 as score", "2 as prediction")
    again = models.score(clash, model, 0.5)
    assert again.columns == ["x", "y", "features", "probability", "prediction", "score", "is_anomaly"] and again.where("score between 0 and 1").count() == 100
    udf = F.pandas_udf(lambda x: (x.fillna(0) > 50).astype(float), "double")
    assert models.score_with(rows, udf, ["x"]).where("is_anomaly").count() == 49


def test_id_blocks(spark):
    ids = spark.range(0, 1_000_000, 1, 8).selectExpr("(id * 7919) % 1000000 as user_id")
    blocks = transforms.id_blocks(ids.unionAll(ids.limit(5000)).unionAll(spark.sql("select cast(null as bigint) as user_id")), size=1000)
    rows = blocks.select("block", "blocks", "n_ids", F.size("participants_id").alias("n"), F.get("participants_id", F.lit(0)).alias("low"), F.get("participants_id", F.lit(999)).alias("high")).collect()
    assert len(rows) == 1000 and all((r.blocks, r.n_ids, r.n, r.low, r.high) == (1000, 1_000_000, 1000, (r.block - 1) * 1000, r.block * 1000 - 1) for r in rows)
    few = transforms.id_blocks(spark.createDataFrame([("b",), ("a",), ("c",), (None,), ("a",)], "who string"), "who", 2)
    assert sorted(tuple(r) for r in few.collect()) == [(1, 2, 3, ["a", "b"]), (2, 2, 3, ["c"])]
    assert transforms.id_blocks(spark.range(0).selectExpr("id as user_id")).count() == 0
    with pytest.raises(ValueError):
        transforms.id_blocks(ids, size=0)
