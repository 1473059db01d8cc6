"""Every operator as a query over the event table.

Requests, bodies and stored tables the queries need are derived from ``events``
by Spark, over the whole table. Queries that write do so below the folder named
by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.classes import OK, TABLE, is_known_type
from tallyfold.functions.digest import body_digest, digest_matches
from tallyfold.functions.identity import client_id
from tallyfold.functions.numbers import gauge_text, parse_float64, parse_int64, value_text
from tallyfold.functions.render import json_list, update_json
from tallyfold.operators import audit, batches, fold, lookup, report, snapshot, validate
from tallyfold.plans.events import (
    as_updates,
    every,
    read_events,
    stream_events,
    stream_events_in_order,
    updates_of,
)
from tallyfold.plans.ingest import ingest_bodies
from tallyfold.session import new_work_dir
from tallyfold.sinks.audit_log import append_audit, read_audit
from tallyfold.sinks.files import write_bodies
from tallyfold.sinks.snapshot import load_snapshot, save_snapshot, write_document
from tallyfold.sinks.state_table import compact_state, upsert_state
from tallyfold.sources.files import REQUEST, read_bodies, read_requests, stream_requests
from tallyfold.sources.snapshot import read_document, snapshot_rows
from tallyfold.sources.state_table import read_state
from tallyfold.sources.updates import explode_batches, parse_batches, parse_paths, parse_updates
from tallyfold.streaming.keyed import (
    read_changes,
    rocksdb_session,
    run_resumed_changes,
    run_state_changes,
)
from tallyfold.streaming.audit import run_audit
from tallyfold.streaming.batches import read_batches, run_batches
from tallyfold.streaming.judged import read_class_counts, run_judged
from tallyfold.streaming.report import (
    read_polls_per_report,
    read_report_windows,
    run_polls_per_report,
    run_report_windows,
)
from tallyfold.streaming.state import run_snapshots, run_state_table

Query = Callable[[SparkSession, str], DataFrame]

KEY = "key"
HOUR = "1 hour"
# Halves that interleave in arrival order, and halves before and after a restart.
_FIRST_HALF = "batch_id % 2 = 0"
_BEFORE_RESTART = "coalesce(ts < TIMESTAMP_NTZ'2024-01-16 00:00:00', true)"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query; ``seq`` fits a BIGINT here and is shown as one."""

    @functools.wraps(function)
    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = function(spark, sf_dir)
        if "gauge_seq" in rows.columns:
            rows = rows.drop("gauge_seq")
        return rows.withColumn("seq", F.col("seq").cast("bigint")) if "seq" in rows.columns else rows

    QUERIES[function.__name__] = shown
    return shown


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.classify(updates_of(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ok(updates_of(spark, sf_dir))


def _ok(updates: DataFrame) -> DataFrame:
    """Good rows, each taken as a request of its own, so no batch refuses them."""
    single = updates.withColumn("form", F.lit("path"))
    return validate.quarantine(validate.classify(single))[0].drop("update_class")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    valid = _valid(spark, sf_dir)
    return valid.where(_FIRST_HALF), valid.where(f"not ({_FIRST_HALF})")


def _record() -> list[Column]:
    return [F.col("name"), F.col("metric_type"), F.col("delta"), F.col("value")]


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_updates(_valid(spark, sf_dir))


# --- state ---------------------------------------------------------------


@query
def metrics_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(spark, sf_dir)


@query
def counter_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.sum_counters(_valid(spark, sf_dir))


@query
def gauge_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.last_gauges(_valid(spark, sf_dir))


@query
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.first_seen(_valid(spark, sf_dir))


@query
def merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier, later = _halves(spark, sf_dir)
    return fold.merge_states(fold.fold_updates(earlier), fold.fold_updates(later))


@query
def latest_per_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.latest_per_name(_valid(spark, sf_dir))


@query
def latest_of_any_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows nobody has judged: other types are kept as they are."""
    return fold.latest_per_name(updates_of(spark, sf_dir))


@query
def newest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.newest_rows(_valid(spark, sf_dir)).select(
        "seq", "batch_id", "pos", "ts", "client", *[c for c in ("name", "metric_type", "delta", "value")]
    )


@query
def metrics_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.listing(_state(spark, sf_dir))


@query
def all_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.all_gauges(_state(spark, sf_dir))


@query
def all_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.all_counters(_state(spark, sf_dir))


@query
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.point_lookup(_state(spark, sf_dir), "gauge", "click").select("name", "gauge_value")


@query
def bulk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lookup per update; every 19th asks for a name nobody has sent."""
    requests = updates_of(spark, sf_dir).select(
        "seq",
        F.when(every(19), F.concat("name", F.lit("-none"))).otherwise(F.col("name")).alias("name"),
        "metric_type",
    )
    return lookup.answer_lookups(requests, _state(spark, sf_dir))


# --- judging -------------------------------------------------------------


@query
def update_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).groupBy("update_class").agg(F.count("*").alias("updates"))


@query
def observed_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that come with writing both sides."""
    folder = new_work_dir(spark, "judged")
    return validate.class_counts(spark, validate.write_judged(_judged(spark, sf_dir), folder))


@query
def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.quarantine(_judged(spark, sf_dir))[0].drop("form")


@query
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.quarantine(_judged(spark, sf_dir))[1].drop("form")


@query
def atomic_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.accepted_updates(updates_of(spark, sf_dir)).drop("form", "update_class")


@query
def prefix_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.accepted_updates(
        updates_of(spark, sf_dir), on_invalid=validate.APPLY_PREFIX
    ).drop("form", "update_class")


@query
def known_type_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.skip_unknown_types(updates_of(spark, sf_dir)).select(
        "seq", "name", "metric_type", "delta", "value"
    )


@query
def state_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate state row per event, broken by rule."""
    base = as_updates(read_events(spark, sf_dir))
    name = (
        F.when(every(101), F.lit("repeated"))
        .when(every(103, 1), F.concat(F.repeat(F.lit("n"), F.lit(101)), F.col("seq")))
        .when(every(113, 5), F.lit(None).cast("string"))
        .otherwise(F.concat_ws("-", "name", "seq"))
    )
    counter = F.when(
        F.col("metric_type") == "counter",
        F.when(every(109, 3), F.lit(3_000_000_000)).otherwise(F.col("delta")),
    )
    gauge = F.when((F.col("metric_type") == "gauge") | every(107, 2), F.coalesce("value", F.lit(0.5)))
    rows = base.select(
        name.alias("name"),
        "metric_type",
        gauge.alias("gauge_value"),
        counter.alias("counter_value"),
        F.col("ts").alias("first_seen"),
    )
    return validate.state_violations(rows)


@query
def request_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the events as path requests, the others as JSON, all as batches."""
    updates = updates_of(spark, sf_dir)
    singles = updates.withColumn("form", F.when(every(3), "path").otherwise("json"))
    single = validate.single_outcomes(validate.classify(singles)).select(
        "form", "http_status", "applied"
    )
    whole = validate.batch_outcomes(validate.classify(updates)).select(
        F.lit("batch").alias("form"), "http_status", "applied"
    )
    return validate.outcome_report(single.unionByName(whole))


# --- requests as text ----------------------------------------------------


def _other_case(body: Column) -> Column:
    for key, written in (("id", "ID"), ("type", "Type"), ("delta", "DELTA"), ("value", "vALUE")):
        body = F.replace(body, F.lit(f'"{key}":'), F.lit(f'"{written}":'))
    return body


def _json_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON body per event, some broken."""
    body = update_json(*_record())
    broken = (
        F.when(every(31, 5), F.concat(F.lit("["), body))
        .when(every(37, 3), F.concat(body, F.lit(" x")))
        .when(every(41, 7), F.regexp_replace(body, '"id":"[^"]*"', '"id":5'))
        .when(every(43, 9), F.regexp_replace(body, "}$", ',"value":"1"}'))
        .when(every(53, 2), F.concat(body, F.lit('],"x":[1')))
        .when(every(59, 1), F.concat(body, F.lit('],"items":[{"id":"b","type":"counter","delta":7}')))
        .when(every(5), _other_case(body))
        .otherwise(body)
    )
    return updates_of(spark, sf_dir).select("seq", broken.alias("body"))


@query
def json_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_updates(_json_requests(spark, sf_dir)).drop("body", "hash")


def _batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON body per batch of ten, with a digest header; some broken."""
    bodies = (
        updates_of(spark, sf_dir)
        .groupBy("batch_id")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("pos", update_json(*_record()).alias("update")))
            ).alias("rows"),
            F.max("ts").alias("ts"),
            F.min_by("client", "pos").alias("client"),
        )
        .withColumn("body", json_list(F.transform("rows", lambda row: row["update"])))
    )
    batch = F.col("batch_id")
    body = (
        F.when(batch % 13 == 4, F.concat("body", F.lit("]")))
        .when(batch % 19 == 6, F.regexp_replace("body", "]$", ',{"id":"late","delta":1.5}]'))
        .when(batch % 29 == 8, F.lit("[]"))
        .when(batch % 31 == 9, F.concat("body", F.lit('],"items":[[{"id":"b","type":"counter","delta":7}]')))
        .when(batch % 7 == 3, _other_case(F.col("body")))
        .otherwise(F.col("body"))
    )
    signed = bodies.select("batch_id", "ts", "client", body.alias("body"))
    header = F.when(batch % 23 == 1, F.lit("00")).otherwise(body_digest(F.col("body"), KEY))
    return signed.withColumn("digest", header)


@query
def json_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies read from compressed request files."""
    folder = new_work_dir(spark, "requests")
    requests = _batch_requests(spark, sf_dir).select(*REQUEST.fieldNames())
    requests.write.option("compression", "gzip").json(folder)
    return explode_batches(parse_batches(read_requests(spark, folder))).drop("ts", "client", "form")


@query
def stream_json_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of request files, judged as bodies, into the state table."""
    folder = new_work_dir(spark, "stream-requests")
    requests = _batch_requests(spark, sf_dir).select(*REQUEST.fieldNames())
    requests.repartition(4, "batch_id").write.option("compression", "gzip").json(f"{folder}/in")
    stream = stream_requests(spark, f"{folder}/in", files_per_trigger=1)
    judged = validate.judge_batches(parse_batches(stream), on_invalid=validate.APPLY_PREFIX, key=KEY)
    run_state_table(
        validate.applied_updates(judged), f"{folder}/state", f"{folder}/checkpoint", "stream"
    ).awaitTermination()
    return read_state(spark, f"{folder}/state").drop("first_seen")


def _verdicts(spark: SparkSession, sf_dir: str, on_invalid: str) -> DataFrame:
    judged = validate.judge_batches(
        parse_batches(_batch_requests(spark, sf_dir)), on_invalid=on_invalid, key=KEY
    )
    return judged.select(
        "batch_id",
        "http_status",
        "applied",
        F.size(F.filter("items", lambda item: is_known_type(item["type"])))
        .cast("bigint")
        .alias("applied_updates"),
        F.array_join("audit_ids", ",").alias("audit_ids"),
    )


@query
def atomic_body_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir, validate.REJECT_BATCH)


@query
def prefix_body_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir, validate.APPLY_PREFIX)


@query
def path_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.coalesce(
        F.when(F.col("metric_type") == "gauge", gauge_text(F.col("value"))),
        F.col("delta").cast("string"),
        F.lit("ABC"),
    )
    name = F.when(every(29, 3), "").otherwise(F.col("name"))
    value = F.when(every(37, 5), "10.66").otherwise(number)
    path = F.concat(F.lit("/update/"), "metric_type", F.lit("/"), name, F.lit("/"), value)
    requests = updates_of(spark, sf_dir).select(
        "seq", "batch_id", "pos", F.when(every(41, 6), F.concat(path, F.lit("/more"))).otherwise(path).alias("path")
    )
    parsed = parse_paths(requests).withColumn("form", F.lit("path"))
    return validate.single_outcomes(validate.classify(parsed)).select(
        "seq", "name", "metric_type", "delta", "value", "update_class", "http_status", "applied"
    )


@query
def client_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    header = (
        F.when(event % 5 == 0, "")
        .when(event % 5 == 1, " 10.1.2.3\t, 8.8.8.8")
        .when(event % 5 == 2, " ,b")
    )
    user = F.col("user_id").cast("string")
    peer = (
        F.when(event % 4 == 0, F.concat(F.lit("10.0.0."), user, F.lit(":51234")))
        .when(event % 4 == 1, F.concat(F.lit("[fe80::"), user, F.lit("]:80")))
        .when(event % 4 == 2, F.concat(F.lit("fe80::"), user))
        .otherwise("socket")
    )
    return read_events(spark, sf_dir).select("event_id", client_id(header, peer).alias("client"))


@query
def parsed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    k, value = F.get_json_object("props", "$.k"), F.col("value").cast("string")
    spellings = [
        k, value, F.concat(F.lit("+"), k), F.concat(F.lit(" "), k), F.concat(k, F.lit("d")),
        F.lit("0x1p3"), F.concat(k, F.lit("e400")), F.concat(F.lit("-."), k, F.lit("e3")),
        F.concat(k, F.lit("_000")), F.concat(k, F.lit("9223372036854775807")), F.concat(k, F.lit(".")),
        F.concat(F.lit("0x"), k), F.concat(k, F.lit("e-1")),
    ]
    text = F.lit("")
    for position, spelling in enumerate(spellings):
        text = F.when(event % 13 == position, spelling).otherwise(text)
    return read_events(spark, sf_dir).select(
        "event_id", parse_int64(text).alias("as_int"), parse_float64(text).alias("as_float")
    )


@query
def payload_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    body, header = F.col("body"), F.col("digest")
    return _batch_requests(spark, sf_dir).select(
        "batch_id",
        body_digest(body, KEY).alias("digest"),
        digest_matches(body, KEY, header).alias("matches"),
    )


@query
def value_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = value_text(F.col("metric_type"), F.col("delta"), F.col("value"))
    return updates_of(spark, sf_dir).select("seq", text.alias("value_text"))


@query
def rendered_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    hash_ = F.when(every(7), "").when(every(11), "abc")
    return updates_of(spark, sf_dir).select("seq", update_json(*_record(), hash_).alias("body"))


# --- outgoing ------------------------------------------------------------


@query
def chunked_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.chunk_updates(_valid(spark, sf_dir)).select("seq", "client", "chunk")


def _outgoing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.pack_batches(batches.chunk_updates(_valid(spark, sf_dir)), KEY)


@query
def outgoing_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outgoing(spark, sf_dir)


@query
def gzipped_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outgoing bodies written compressed, read back and folded."""
    folder = new_work_dir(spark, "bodies")
    write_bodies(_outgoing(spark, sf_dir), folder)
    received = parse_batches(read_bodies(spark, folder))
    rows = received.select(F.inline("items"))
    return rows.groupBy(F.col("id").alias("name"), F.col("type").alias("metric_type")).agg(
        F.count("*").alias("updates"), F.sum("delta").alias("counter_value")
    )


# --- audit ---------------------------------------------------------------


def _joined_ids(events: DataFrame) -> DataFrame:
    return events.withColumn("metrics", F.array_join("metrics", ","))


@query
def audit_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_ids(audit.audit_single(_judged(spark, sf_dir)))


@query
def audit_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_ids(audit.audit_batches(_judged(spark, sf_dir)))


@query
def audit_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "audit")
    append_audit(audit.audit_batches(_judged(spark, sf_dir)), folder)
    return _joined_ids(read_audit(spark, folder))


@query
def audit_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a stream delivered to two sinks."""
    folder = new_work_dir(spark, "fanout")
    judged = validate.classify(as_updates(stream_events(spark, sf_dir)))
    sinks = [
        lambda events, epoch: append_audit(events, f"{folder}/a", "stream", epoch),
        lambda events, epoch: append_audit(events, f"{folder}/b", "stream", epoch),
    ]
    run_audit(audit.audit_single(judged), sinks, f"{folder}/checkpoint").awaitTermination()
    first = read_audit(spark, f"{folder}/a").withColumn("sink", F.lit("a"))
    second = read_audit(spark, f"{folder}/b").withColumn("sink", F.lit("b"))
    return _joined_ids(first.unionByName(second))


# --- stored state and snapshots -------------------------------------------


@query
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four upserts of interleaved parts, not in order, one of them replayed; then a scan."""
    folder = new_work_dir(spark, "state")
    valid = _valid(spark, sf_dir)
    for epoch, part in enumerate((1, 0, 3, 2)):
        for _ in range(1 + (epoch == 2)):
            upsert_state(fold.fold_updates(valid.where(f"batch_id % 4 = {part}")), folder, "batch", epoch)
    return read_state(spark, folder)


@query
def compacted_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three epochs merged into a new table, its newest one replayed, then a fourth."""
    folder = new_work_dir(spark, "compacted")
    valid = _valid(spark, sf_dir)

    def add(table: str, epoch: int) -> None:
        upsert_state(fold.fold_updates(valid.where(f"batch_id % 4 = {epoch}")), f"{folder}/{table}", "batch", epoch)

    for epoch in range(3):
        add("first", epoch)
    compact_state(spark, f"{folder}/first", f"{folder}/second")
    add("second", 2)
    add("second", 3)
    return read_state(spark, f"{folder}/second")


@query
def stored_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan of stored state that reads the gauge folder only."""
    folder = new_work_dir(spark, "state")
    upsert_state(_state(spark, sf_dir), folder, "batch", 0)
    return lookup.all_gauges(read_state(spark, folder))


def _ingested(spark: SparkSession, sf_dir: str, **store: str) -> DataFrame:
    folder = new_work_dir(spark, "ingest")
    places = [f"{folder}/{part}" for part in ("state", "audit", "staging")]
    ingest_bodies(_batch_requests(spark, sf_dir), *places, writer="batch", epoch=0, key=KEY, **store)
    return read_state(spark, places[0]).drop("first_seen")


@query
def ingested_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole write path from signed bodies to stored state; batches apply up to their
    first bad update."""
    return _ingested(spark, sf_dir)


@query
def ingested_table_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the table store, which refuses a batch with a bad update."""
    return _ingested(spark, sf_dir, store=TABLE)


@query
def snapshot_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_rows(snapshot.snapshot_documents(_state(spark, sf_dir))).drop("first_seen")


@query
def snapshot_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "snapshot")
    save_snapshot(_state(spark, sf_dir), folder)
    return load_snapshot(spark, folder).drop("first_seen")


@query
def snapshot_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of all keys over several files, and back line by line."""
    folder = new_work_dir(spark, "document")
    write_document(_state(spark, sf_dir), folder)
    return read_document(spark, folder).drop("first_seen")


# --- reports and streams --------------------------------------------------


@query
def report_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_windows(_valid(spark, sf_dir), HOUR)


@query
def polls_per_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.polls_per_report(updates_of(spark, sf_dir), HOUR)


def _valid_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ok(as_updates(stream_events(spark, sf_dir)))


@query
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "stream-state")
    run_state_table(
        _valid_stream(spark, sf_dir), f"{folder}/state", f"{folder}/checkpoint", "stream"
    ).awaitTermination()
    return read_state(spark, f"{folder}/state")


@query
def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "stream-snapshot")
    run_snapshots(
        _valid_stream(spark, sf_dir), f"{folder}/snapshot", f"{folder}/checkpoint", "stream", 0
    ).awaitTermination()
    return load_snapshot(spark, f"{folder}/snapshot").drop("first_seen")


@query
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the first half, then a stream of the second."""
    folder = new_work_dir(spark, "stream-resume")
    earlier = _valid(spark, sf_dir).where(_BEFORE_RESTART)
    save_snapshot(fold.fold_updates(earlier), f"{folder}/snapshot")
    later = _valid_stream(spark, sf_dir).where(f"not ({_BEFORE_RESTART})")
    run_state_table(
        later,
        f"{folder}/state",
        f"{folder}/checkpoint",
        "stream",
        snapshot=f"{folder}/snapshot",
    ).awaitTermination()
    return read_state(spark, f"{folder}/state").drop("first_seen")


@query
def stream_report_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "stream-report")
    run_report_windows(
        _valid_stream(spark, sf_dir), f"{folder}/windows", f"{folder}/checkpoint", "stream", HOUR
    ).awaitTermination()
    return read_report_windows(spark, f"{folder}/windows")


@query
def stream_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "stream-polls")
    run_polls_per_report(
        as_updates(stream_events(spark, sf_dir)), f"{folder}/polls", f"{folder}/checkpoint", "stream", HOUR
    ).awaitTermination()
    return read_polls_per_report(spark, f"{folder}/polls")


@query
def stream_state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State kept by the stream's store, delivered as changed keys with a full one between."""
    folder = new_work_dir(spark, "stream-changes")
    session = rocksdb_session(spark)
    run_state_changes(
        _valid_stream(session, sf_dir), f"{folder}/state", f"{folder}/checkpoint", full_every=2
    ).awaitTermination()
    return read_changes(spark, f"{folder}/state")


@query
def stream_resume_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the first half becomes the initial state of a stream of the second."""
    folder = new_work_dir(spark, "stream-resume-keyed")
    session = rocksdb_session(spark)
    earlier = _valid(session, sf_dir).where(_BEFORE_RESTART)
    save_snapshot(fold.fold_updates(earlier), f"{folder}/snapshot")
    later = _valid_stream(session, sf_dir).where(f"not ({_BEFORE_RESTART})")
    run_resumed_changes(
        later, f"{folder}/state", f"{folder}/checkpoint", load_snapshot(session, f"{folder}/snapshot")
    ).awaitTermination()
    return read_changes(spark, f"{folder}/state").drop("first_seen")


@query
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that left as their chunks filled up, and the ones still open at the end."""
    folder = new_work_dir(spark, "stream-batches")
    updates = _ok(as_updates(stream_events_in_order(spark, sf_dir)))
    run_batches(updates, f"{folder}/out", f"{folder}/checkpoint", key=KEY, full_every=2).awaitTermination()
    return read_batches(spark, f"{folder}/out", KEY, waiting=True)


@query
def stream_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark, "stream-judged")
    judged = validate.classify(as_updates(stream_events(spark, sf_dir)))
    run_judged(judged, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_class_counts(spark, f"{folder}/out")
