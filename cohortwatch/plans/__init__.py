"""Ready-made queries over the event tables, with their DuckDB counterparts.

The point in time is always the newest event, never the wall clock.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.functions.templates import action_time
from cohortwatch.operators import actions, checks, conditions, models, transforms
from cohortwatch.plans import kept
from cohortwatch.plans.common import DAY, as_messages, events_of, newest
from cohortwatch.plans.oracles import ORACLES
from cohortwatch.sources import readers, schemas, scratch, writers
from cohortwatch.streaming import monitor

def _missing(events: DataFrame, window=DAY, as_of=None) -> DataFrame:
    return checks.missing_participants(events, newest(events) if as_of is None else as_of, window)


#: Ids that one report holds.
REPORT_IDS = 1000


def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report for each block of silent participants."""
    events = events_of(spark, sf_dir)
    blocks = transforms.id_blocks(_missing(events), size=REPORT_IDS).select(F.struct("participants_id", "block", "blocks", "n_ids").alias("missing"))
    notify = actions.Action("notify_missing_data", "send_notification", "size(missing.participants_id) > 0", settings={"message": "Missing data detected for participants: {{ missing.participants_id }}"})
    found = actions.report(blocks, notify, newest(events))
    return found.select("name", "type", F.col("metadata.message").alias("message"), F.size("data.missing.participants_id").alias("n_participants"))


def missing_report_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of at most four participants each, with their number and the count of all."""
    events = events_of(spark, sf_dir)
    blocks = transforms.id_blocks(_missing(events), size=4)
    notify = actions.Action("notify", settings={"message": "{{ n_ids }} participants are silent, part {{ block }} of {{ blocks }}: {{ participants_id }}"})
    return actions.report(blocks, notify, newest(events)).select("data.block", F.col("metadata.message").alias("message"))


def missing_24h(spark, sf_dir):
    return _missing(events_of(spark, sf_dir))


def missing_from_roster(spark, sf_dir):
    events = events_of(spark, sf_dir)
    roster = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("long").alias("user_id"))
    return checks.missing_participants(events, F.lit(newest(events)), 3 * DAY, roster)


def missing_fraction_3d(spark, sf_dir):
    events = events_of(spark, sf_dir)
    return checks.missing_fraction(events, F.lit(newest(events)), 3 * DAY, DAY)


def recent_literal(spark, sf_dir):
    events = events_of(spark, sf_dir)
    return transforms.recent(events, "ts", newest(events) - F.lit(10 * DAY)).groupBy("user_id").agg(F.count("*").alias("n_events"))


def spikes_200(spark, sf_dir):
    return transforms.spikes_by_user(events_of(spark, sf_dir), "value", 200)


def spike_flags(spark, sf_dir):
    return transforms.flag_spikes(events_of(spark, sf_dir), "value", 200).select("event_id", "is_anomaly")


def missing_backoff(spark, sf_dir):
    events = events_of(spark, sf_dir)
    now = newest(events)
    before = now - F.lit(DAY)
    log = checks.alert_log(_missing(events.where(F.col("ts") <= before), DAY, before), "notify", before)
    return checks.without_recent_alerts(_missing(events), log, now, 2 * DAY).select("user_id")


def quality_metrics(spark, sf_dir):
    return checks.quality_metrics(events_of(spark, sf_dir), ["event_id", "value", "props"], {"value": (0, 200)}, ["event_id"])


def json_props(spark, sf_dir):
    messages = as_messages(events_of(spark, sf_dir))
    good, _ = readers.split_corrupt(readers.decode(messages, schemas.struct(k=schemas.INT), keep=("topic", "offset")))
    return good.select("offset", "topic", "k")


def json_variant(spark, sf_dir):
    messages = readers.decode_any(as_messages(events_of(spark, sf_dir)))
    return messages.select("offset", F.try_variant_get("payload", "$.k", "bigint").alias("k"), F.try_variant_get("payload", "$.none", "string").alias("absent"))


def schema_violations(spark, sf_dir):
    messages = as_messages(events_of(spark, sf_dir))
    parts = []
    for name, kind in (("int", schemas.INT), ("boolean", schemas.BOOL)):
        decoded = readers.decode(messages, schemas.struct(k=kind, device=schemas.TEXT))
        parts.append(checks.schema_violations(decoded, ["device"]).withColumn("schema", F.lit(name)))
    return readers.unite(parts)


def rendered_alert(spark, sf_dir):
    events = events_of(spark, sf_dir)
    blocks = transforms.id_blocks(events.where("value > 300"), size=REPORT_IDS).select(F.struct("participants_id").alias("high"))
    action = actions.Action("alert", settings={"message": "High values: {{ high.participants_id }}, first {{ high.participants_id.0 }}{{ high.none }}", "ids": "{{ high.participants_id }}"})
    return actions.report(blocks, action, newest(events)).select(F.col("metadata.message").alias("message"), F.size("metadata.ids").cast("long").alias("n_ids"))


def scheduled_times(spark, sf_dir):
    events = events_of(spark, sf_dir)
    now = events.agg(F.max("ts").alias("as_of"))
    as_of = F.col("as_of")
    plain = lambda c: c.cast("timestamp_ntz")
    return now.select(*[plain(action_time(w, as_of)).alias(n) for n, w in (("soon", timedelta(minutes=5)), ("evening", "8:30pm"), ("at_once", "immediate"), ("unknown", "garbage"))])


def gated_reports(spark, sf_dir):
    """The gate looks at the first block of ids, whose number tells how many there are."""
    events = events_of(spark, sf_dir)
    first = transforms.id_blocks(_missing(events), size=REPORT_IDS).where("block = 1")
    one = first.agg(F.coalesce(F.max("participants_id"), F.expr("cast(array() as array<bigint>)")).alias("participants_id"), F.coalesce(F.max("n_ids"), F.lit(0)).alias("n_ids"))
    context = actions.gather({"check": one})
    both = [actions.Action("notify", "send_notification", ["size(check.participants_id) > 0", "check.participants_id <> array()", "check.n_ids > 0"], settings={"n": "{{ check.participants_id.0 }}"}), actions.Action("quiet", "send_notification", "size(check.participants_id) = 0")]
    return actions.report_messages(context, both, F.lit(newest(events))).select("name", F.get_json_object("value", "$.type").alias("type"), F.get_json_object("value", "$.metadata.n").alias("first_id"))


def gate_on_long_result(spark, sf_dir):
    return conditions.holds_for_any(events_of(spark, sf_dir), "value > 300")


def alert_table(spark, sf_dir):
    events = events_of(spark, sf_dir)
    found = transforms.spikes_by_user(events, "value", 200)
    rows = actions.alert_rows(found, "high_rate", "email", F.lit(newest(events)), recipients=["team"], subject="Spikes of {{ user_id }}", body="{{ n_spikes }} above the limit", when=timedelta(minutes=5))
    return rows.select("action", "method", "user_id", "subject", "body", F.col("due_at").cast("timestamp_ntz").alias("due_at"), F.col("alerted_at").cast("timestamp_ntz").alias("alerted_at"))


def event_envelope(spark, sf_dir):
    rows = events_of(spark, sf_dir).select("event_id", F.col("user_id").cast("string").alias("user_id"), "event_type")
    return writers.keyed_messages(rows).select("key", F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), F.get_json_object("value", "$.event_type").alias("event_type"))


def report_envelope(spark, sf_dir):
    rows = events_of(spark, sf_dir).select("event_id", "value", "event_type")
    return writers.messages(rows.withColumn("goes_to", F.concat(F.lit("t-"), "event_type")), "goes_to").select("topic", F.get_json_object("value", "$.event_id").cast("long").alias("event_id"))


def message_text(spark, sf_dir):
    return readers.shown(as_messages(events_of(spark, sf_dir)))


def cap_per_group(spark, sf_dir):
    return transforms.cap_per_group(events_of(spark, sf_dir), 2, "user_id", ("ts", "event_id")).select("user_id", "event_id")


def cleaned_events(spark, sf_dir):
    return transforms.clean(events_of(spark, sf_dir), ["event_id"], {"value": (0, 200)}).select("event_id", "value")


def union_sources(spark, sf_dir):
    events = events_of(spark, sf_dir).select("event_id", "event_type", "value", "props")
    return readers.unite([events.where("event_type = 'purchase'"), events.where("event_type <> 'purchase'").drop("props")])


def parsed_times(spark, sf_dir):
    text = events_of(spark, sf_dir).select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))
    return transforms.parse_time(text).select("event_id", F.col("timestamp").cast("timestamp_ntz").alias("ts"))


def score_threshold(spark, sf_dir):
    events = events_of(spark, sf_dir)
    per_user = events.groupBy("user_id").agg(F.count("*").cast("double").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("top"))
    per_user = per_user.withColumn("label", (F.col("top") > 200).cast("double"))
    model = models.train(per_user, ["n", "mean"], "label", epochs=30)
    return models.score(per_user, model).select("user_id", "score", "is_anomaly")


def saved_result(spark, sf_dir):
    base = scratch.folder(spark, "results")
    writers.save_result(_missing(events_of(spark, sf_dir)), base, "Sample_Missing_Data", "missing_24h")
    return writers.load_result(spark, base, "sample_missing_data", "missing_24h")


def csv_sources(spark, sf_dir):
    base = scratch.folder(spark, "csv")
    events = events_of(spark, sf_dir).select("event_id", "event_type", "value")
    events.where("event_type = 'purchase'").write.csv(f"{base}/a", header=True)
    events.where("event_type <> 'purchase'").select("event_type", "event_id").write.csv(f"{base}/b", header=True)
    return readers.read_csv(spark, [f"{base}/a", f"{base}/b"], schemas.struct(event_id=schemas.LongType(), event_type=schemas.TEXT, value=schemas.DOUBLE))


@contextmanager
def _state_store(spark: SparkSession):
    """The state store that timers and state variables need, while a stream runs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, monitor.STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def streaming_missing(spark, sf_dir):
    """The missing-data check as a stream over the whole table, run until all is read."""
    schema = events_of(spark, sf_dir).schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parq*")
    base = scratch.folder(spark, "silence")
    with _state_store(spark):
        found = monitor.silent_participants(stream.withColumn("ts", F.col("ts").cast("timestamp")), DAY)
        monitor.pull(found, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema("user_id long, last_seen timestamp").parquet(f"{base}/out").select("user_id")


def _delivered(spark: SparkSession, parts, make_stream: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What a stream makes of several deliveries, one after another: each is added to a folder and pulled from the position before."""
    base, schema = scratch.folder(spark, name), None
    with _state_store(spark):
        for part in parts:
            part.write.mode("append").parquet(f"{base}/in")
            found = make_stream(spark.readStream.schema(part.schema).parquet(f"{base}/in"))
            monitor.pull(found, f"{base}/out", f"{base}/checkpoint").awaitTermination()
            schema = found.schema
    return spark.read.schema(schema).parquet(f"{base}/out")


def streaming_roster(spark, sf_dir):
    """Silence of a roster's members, over three deliveries in event order: who never sent, or not for three days at the end."""
    events = events_of(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    roster = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("long").alias("user_id"), F.lit(first).alias("since"))
    cuts = [first + (last - first) * k / 3 for k in range(3)] + [last + DAY]
    parts = (events.where((F.col("ts") >= a) & (F.col("ts") < b)) for a, b in zip(cuts, cuts[1:]))
    changes = _delivered(spark, parts, lambda stream: monitor.roster_silence(stream, roster, 3 * DAY), "roster")
    return monitor.silent_now(changes).select("user_id", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"))


def streaming_backoff(spark, sf_dir):
    """The silent of the last day but one and of the last, as two deliveries; alerts on those not alerted within two days before."""
    events = events_of(spark, sf_dir)
    now = newest(events)
    found = (_missing(events.where(F.col("ts") <= as_of), DAY, as_of).select("user_id", as_of.cast("timestamp").alias("found_at")) for as_of in (now - F.lit(DAY), F.lit(now)))
    alerts = _delivered(spark, found, lambda stream: monitor.with_backoff(stream, 2 * DAY), "backoff")
    return alerts.where(F.col("found_at") == F.lit(now).cast("timestamp")).select("user_id")


def streaming_repeats(spark, sf_dir):
    """Events that come twice, once each: a stream of two copies of the table."""
    events = events_of(spark, sf_dir)
    base = scratch.folder(spark, "repeats")
    events.unionAll(events).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{base}/in").schema).parquet(f"{base}/in")
    monitor.pull(monitor.without_repeats(stream, ["event_id"], "1 day").select("event_id", "value"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def custom_check(spark, sf_dir):
    def busy(rows: DataFrame, least: int) -> DataFrame:
        return rows.groupBy("user_id").agg(F.count("*").alias("n")).where(F.col("n") >= least)

    return transforms.custom(events_of(spark, sf_dir), busy, least=70)


def nested_report(spark, sf_dir):
    """Settings with nested mappings and lists, one report for each user with a spike."""
    found = transforms.spikes_by_user(events_of(spark, sf_dir), "value", 200)
    settings = {"to": ["{{ user_id }}", "{{ user_id }}"], "mixed": ["{{ user_id }}", "x", True], "parts": [{"n": "{{ n_spikes }}"}, {"n": "{{ n_spikes }}"}], "deep": {"text": "n={{ n_spikes }}"}}
    reports = actions.report(found, actions.Action("nested", settings=settings), newest(events_of(spark, sf_dir)))
    return reports.select("data.user_id", F.to_json("metadata").alias("metadata"))


def unresolved_tokens(spark, sf_dir):
    """Whole tokens whose path is not there, or whose value is NULL, keep their text."""
    rows = events_of(spark, sf_dir).select("event_id", F.when(F.col("value") <= 100, F.col("event_type")).alias("kind"), F.array("event_type").alias("kinds"))
    text = {"kind": "{{ kind }}", "none": "{{ no.such }}", "far": "{{ kinds.3 }}", "inside": "<{{ kind }}{{ no.such }}>"}
    return actions.report(rows, actions.Action("tokens", settings=text), newest(events_of(spark, sf_dir))).select("data.event_id", "metadata.*")


def json_edge_cases(spark, sf_dir):
    """Values behind white space, of no object, cut off, and with a field named like a column of the envelope."""
    events = events_of(spark, sf_dir)
    case = F.pmod("event_id", F.lit(6))
    value = F.when(case == 0, F.concat(F.lit("\n"), "props")).when(case == 1, F.concat(F.lit(" \t\r\n"), "props")).when(case == 2, F.lit("[1]")).when(case == 3, F.expr("left(props, length(props) - 1)")).when(case == 4, F.concat(F.lit('{"timestamp": "t'), F.col("event_id").cast("string"), F.lit('"}')))
    decoded = readers.decode(as_messages(events.withColumn("value_text", value), "value_text"), schemas.struct(k=schemas.INT, timestamp=schemas.TEXT), keep=("topic", "offset", "timestamp"))
    return decoded.select("offset", "k", "timestamp", F.col("message_timestamp").cast("timestamp_ntz").alias("sent_at"), F.col(readers.CORRUPT).isNotNull().alias("corrupt"))


def payload_schemas(spark, sf_dir):
    """Messages of every topic, made of the events by the topic's payload schema, and decoded by it: good ones, and the sum of their set fields."""
    events = events_of(spark, sf_dir)

    def value(kind):
        if isinstance(kind, schemas.StructType):
            return F.struct(*[value(f.dataType).alias(f.name) for f in kind.fields])
        of = {schemas.INT: F.pmod("event_id", F.lit(1000)), schemas.DOUBLE: F.col("value"), schemas.BOOL: F.lit(True)}
        return of.get(kind, F.col("event_id")).cast(kind)

    parts = []
    for topic, schema in schemas.TOPICS.items():
        decoded, _ = readers.split_corrupt(readers.decode(events.select(F.to_json(value(schema)).alias("value"), F.lit(topic).alias("topic")), schema))
        here = sum((F.col(f"`{f.name}`").isNotNull().cast("int") for f in schema.fields), F.lit(0))
        parts.append(decoded.groupBy("topic").agg(F.count("*").alias("n"), F.sum(here).alias("n_set")))
    return readers.unite(parts)


def source_by_type(spark, sf_dir):
    return readers.read_source(spark, "parquet", f"{sf_dir}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"))


def custom_by_group(spark, sf_dir):
    """A caller's pandas function, one participant's events at a time."""

    def spread(rows):
        return rows.groupby("user_id", as_index=False).agg(low=("value", "min"), high=("value", "max"))

    return transforms.custom_by_group(events_of(spark, sf_dir).select("user_id", "value"), "user_id", spread, "user_id long, low double, high double")


def fixed_scores(spark, sf_dir):
    """Inference with a fixed logistic model over per-participant features."""
    per_user = events_of(spark, sf_dir).groupBy("user_id").agg(F.count("*").cast("double").alias("n"), F.max("value").alias("top"))
    logistic = lambda n, top: F.round(1 / (1 + F.exp(-(F.col(n) / 64 + F.col(top) / 128 - 3))), 6)
    return models.score_with(per_user, logistic, ["n", "top"], 0.5).select("user_id", "score", "is_anomaly")


def table_round_trip(spark, sf_dir):
    """Daily counts written to a relational table in memory and read again."""
    url, name = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", "DAILY"
    daily = events_of(spark, sf_dir).groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    writers.write_table(daily.coalesce(1), url, name, **_DERBY)
    return readers.read_table(spark, url, name, **_DERBY)


def streaming_reports(spark, sf_dir):
    """Alerts of each micro-batch, written once a batch."""
    stream = spark.readStream.schema(events_of(spark, sf_dir).schema).parquet(f"{sf_dir}/events.parq*")
    base = scratch.folder(spark, "reports")

    def alerts(rows):
        return actions.alert_rows(rows.where("value > 200"), "high", "email", F.col("ts"), subject="Value {{ event_id }}")

    monitor.emit(stream, alerts, monitor.write_once(f"{base}/out"), f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("user_id", "subject", F.col("alerted_at").cast("timestamp_ntz").alias("alerted_at"))


_DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def table_batches(spark, sf_dir):
    """Alerts streamed into a relational table, each batch sent twice, as after a failure between the write and its commit."""
    url, base = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", scratch.folder(spark, "batches")
    stream = spark.readStream.schema(events_of(spark, sf_dir).schema).parquet(f"{sf_dir}/events.parq*")
    sink = writers.table_once(url, "ALERTS", "high", **_DERBY)

    def twice(rows, batch_id):
        sink(rows, batch_id)
        sink(rows, batch_id)

    monitor.emit(stream, lambda rows: rows.where("value > 200").select("event_id", "user_id", "value"), twice, f"{base}/checkpoint").awaitTermination()
    return readers.read_table(spark, url, "ALERTS", **_DERBY)


def redelivered_messages(spark, sf_dir):
    """Reports sent twice under other offsets, once each by the id in their headers."""
    rows = events_of(spark, sf_dir).select("event_id", "event_type")
    sent = writers.identified(writers.messages(rows.withColumn("goes_to", F.lit("reports")), "goes_to"), [F.get_json_object("value", "$.event_id")], "reports")
    again = readers.unite([sent.withColumn("offset", F.get_json_object("value", "$.event_id").cast("long") * 2 + k) for k in (0, 1)]).withColumn("partition", F.lit(0))
    return writers.without_redelivered(again).select("topic", F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), F.get_json_object("value", "$.event_type").alias("event_type"))


_QUERIES = (missing_report_blocks, streaming_roster, streaming_backoff, table_batches, redelivered_messages, nested_report, unresolved_tokens, json_edge_cases, payload_schemas, source_by_type, custom_by_group, fixed_scores, table_round_trip, streaming_reports, missing_report, missing_24h, missing_from_roster, missing_fraction_3d, recent_literal, spikes_200, spike_flags, missing_backoff, quality_metrics, json_props, json_variant, schema_violations, rendered_alert, scheduled_times, gated_reports, gate_on_long_result, alert_table, event_envelope, report_envelope, message_text, cap_per_group, cleaned_events, union_sources, parsed_times, score_threshold, saved_result, csv_sources, streaming_missing, streaming_repeats, custom_check)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries by name."""
    return {f.__name__: f for f in (*_QUERIES, *kept.QUERIES)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by name."""
    return ORACLES | kept.ORACLES
