import json
import time
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F

from cohortwatch.sources import readers, schemas, writers

GOOD = {"device_id": "wearable_001", "user_id": "u1", "heart_rate_bpm": 80, "steps_count": 5, "calories_burned": 1.25, "timestamp": "2024-01-01T12:00:00.123456"}


def messages(spark, *values):
    return spark.createDataFrame([(None, v.encode() if v is not None else None, "wearable-device-data", 0, i, datetime(2024, 1, 1), 0) for i, v in enumerate(values)], schemas.ENVELOPE)


def test_decode_splits_bad_messages_and_drops_tombstones(spark):
    bad = ["not json", "[1,2]", json.dumps(GOOD | {"heart_rate_bpm": "x"}), ""]
    decoded = readers.decode(messages(spark, json.dumps(GOOD), None, *bad), schemas.WEARABLES)
    good, corrupt = readers.split_corrupt(decoded)
    assert [r.asDict() for r in good.collect()] == [GOOD | {"topic": "wearable-device-data"}]
    assert sorted(r._corrupt for r in corrupt.collect()) == sorted(bad)


def test_absent_fields_are_null_and_unknown_ones_ignored(spark):
    good, corrupt = readers.split_corrupt(readers.decode(messages(spark, '{"user_id": "u", "more": 1}'), schemas.WEARABLES))
    row = good.first()
    assert row.user_id == "u" and row.heart_rate_bpm is None and corrupt.count() == 0


def test_decode_any_keeps_every_valid_json(spark):
    assert readers.decode_any(messages(spark, "[1,2]", '{"a": 1}', "3", "nope", None)).count() == 3


@pytest.mark.parametrize("topic", sorted(schemas.TOPICS))
def test_topic_schemas_round_trip(spark, topic):
    schema = schemas.TOPICS[topic]
    row = spark.createDataFrame([tuple(None for _ in schema)], schema)
    text = writers.messages(row).first().value
    assert set(json.loads(text)) == set(schema.names)
    assert readers.split_corrupt(readers.decode(messages(spark, text), schema, keep=()))[0].schema.names == schema.names


def test_topics_are_needed():
    assert readers.topic_names("a") == ["a"] and readers.topic_names(["a", "b"]) == ["a", "b"]
    for none in ("", [], [""]):
        with pytest.raises(ValueError):
            readers.topic_names(none)


def test_kafka_options():
    o = readers.kafka_options("h:1", ["a", "b"], ending="latest", max_per_trigger=1000)
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "earliest" and o["endingOffsets"] == "latest" and o["maxOffsetsPerTrigger"] == "1000"
    o = readers.kafka_options("h:1", "a", since=datetime(2024, 1, 1, tzinfo=timezone.utc))
    assert o["startingTimestamp"] == "1704067200000" and "startingOffsets" not in o
    assert writers.topic_options("h:1", "t")["topic"] == "t" and "topic" not in writers.topic_options("h:1")


def test_unknown_source_is_an_error(spark):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        readers.read_source(spark, "no-such-source", "/nowhere")
    with pytest.raises(AnalysisException):
        readers.read_source(spark, "parquet", "/nowhere")


def test_union_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([(2, 0.5)], "id int, b double")
    assert sorted(map(tuple, readers.unite([a, b]).collect())) == [(1, "x", None), (2, None, 0.5)]
    with pytest.raises(ValueError):
        readers.unite([])


def test_csv_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.5\n2,bad\n")
    (tmp_path / "b.csv").write_text("w,id\nz,3\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    assert sorted(readers.read_csv(spark, paths).columns) == ["id", "v", "w"]
    typed = readers.read_csv(spark, paths, schemas.struct(id=schemas.INT, v=schemas.DOUBLE, none=schemas.TEXT))
    assert sorted(map(tuple, typed.collect())) == [(1, 2.5, None), (2, None, None), (3, None, None)]


def test_tables_over_jdbc(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(100).selectExpr("id", "id * 2 as twice")
    writers.write_table(rows, url, "numbers", "overwrite", **driver)
    writers.write_table(rows.limit(1), url, "numbers", **driver)
    whole = readers.read_tables(spark, url, ["numbers"], **driver)["numbers"]
    assert whole.count() == 101
    parts = readers.read_table(spark, url, "numbers", "id", "0", "100", 4, **driver)
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 101
    with pytest.raises(ValueError):
        readers.read_table(spark, url, "numbers", "id")


def test_named_results(spark, tmp_path):
    base = f"file://{tmp_path}"
    path = writers.save_result(spark.range(3), base, "My_Model", "check")
    writers.save_result(spark.range(2), base, "My_Model", "check")
    assert path.endswith("/my_model/check") and writers.load_result(spark, base, "MY_MODEL", "check").count() == 2
    with pytest.raises(AnalysisException):
        writers.load_result(spark, base, "my_model", "absent")
    with pytest.raises(ValueError):
        writers.result_path(base, "m", "a/b")


def test_message_keys(spark):
    rows = spark.createDataFrame([("u", "d"), ("", "d"), (None, ""), (None, None)], "user_id string, device_id string")
    got = writers.keyed_messages(rows).collect()
    assert [r.key for r in got] == ["u", "d", None, None]
    assert json.loads(got[3].value) == {"user_id": None, "device_id": None}
    assert writers.keyed_messages(spark.range(1)).first().key is None


def test_messages_with_their_own_topic(spark):
    got = writers.messages(spark.createDataFrame([Row(t="a", v=1)]), "t").first()
    assert got.topic == "a" and json.loads(got.value) == {"v": 1}


DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_a_batch_is_in_the_table_once(spark, monkeypatch):
    url = "jdbc:derby:memory:once;create=true"
    rows = spark.range(100).selectExpr("id", "concat('t', id) as text", "id / 2 as half").repartition(4)
    assert writers.write_table_once(rows, url, "T", 0, **DERBY) and not writers.write_table_once(rows, url, "T", 0, **DERBY)
    assert writers.write_table_once(rows.limit(5), url, "T", 0, sink="o'ther", **DERBY) and writers.write_table_once(rows.limit(0), url, "T", 1, **DERBY)
    read = readers.read_table(spark, url, "T", **DERBY)
    assert read.count() == 105 and {c.lower() for c in read.columns} == {"id", "text", "half"}
    # A task that ran again after its commit has left a second attempt of its rows.
    marked = writers._marked
    monkeypatch.setattr(writers, "_marked", lambda df: (lambda m: m.unionAll(m.withColumn("_attempt", F.col("_attempt") + 1000).withColumn("_part", F.col("_part") - 4)))(marked(df)))
    assert writers.write_table_once(rows, url, "T", 2, **DERBY) and readers.read_table(spark, url, "T", **DERBY).count() == 205
    assert not writers.Database(spark, url, **DERBY).has("T_stage_2")


def test_a_batch_is_copied_in_time_by_its_rows(spark, monkeypatch):
    url, took, change = "jdbc:derby:memory:linear;create=true", [], writers.Database.change

    def timed(database, statements):
        start = time.monotonic()
        change(database, statements)
        took.append(time.monotonic() - start)

    monkeypatch.setattr(writers.Database, "change", timed)
    writers.Database(spark, url, **DERBY).change(["CREATE TABLE T_kept_0 (left_by_a_crash INTEGER)"])
    rows = spark.range(0, 20_000, 1, 40).selectExpr("id", "id as attempt", "id as part")
    marked = writers._marked
    monkeypatch.setattr(writers, "_marked", lambda df: (lambda m: m.unionAll(m.withColumn("_attempt", F.col("_attempt") + 1000).withColumn("_part", F.col("_part") - 40)))(marked(df)))
    assert writers.write_table_once(rows, url, "T", 0, **DERBY)
    assert max(took) < 8, took
    got = readers.read_table(spark, url, "T", **DERBY)
    assert got.count() == got.distinct().count() == 20_000 and got.where("id = attempt and id = part").count() == 20_000
    assert not writers.Database(spark, url, **DERBY).has("T_kept_0")


def test_a_batch_that_fails_leaves_nothing(spark, monkeypatch):
    url = "jdbc:derby:memory:failed;create=true"
    rows = spark.range(10).selectExpr("id", "id * 2 as twice")
    writers.write_table_once(rows, url, "T", 0, **DERBY)
    with pytest.raises(Exception):  # noqa: B017
        writers.write_table_once(rows.withColumnRenamed("twice", "thrice"), url, "T", 1, **DERBY)
    assert readers.read_table(spark, url, "T", **DERBY).count() == 10
    assert writers.write_table_once(rows, url, "T", 1, **DERBY) and readers.read_table(spark, url, "T", **DERBY).count() == 20
    with pytest.raises(Exception):  # noqa: B017
        writers.Database(spark, url, **DERBY).change(['INSERT INTO T ("id") VALUES (1)', "INSERT INTO NONE VALUES (1)"])
    assert readers.read_table(spark, url, "T", **DERBY).count() == 20


def test_identified_messages(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "a")], "id long, text string")
    sent = writers.identified(writers.messages(rows), ["value"], "s")
    ids = [r[0] for r in sent.select(writers.message_id()).collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[1] and all(ids)
    other = writers.identified(writers.messages(rows), ["value"], "t").select(writers.message_id()).first()[0]
    assert other != ids[0]
    plain = rows.selectExpr("cast(id as string) as value", "'t' as topic", "0 as partition", "id as offset", "cast(null as array<struct<key:string,value:binary>>) as headers")
    assert writers.without_redelivered(plain.where("offset is not null")).count() == 2  # no id: told by their place, of which (t, 0, 1) comes twice
