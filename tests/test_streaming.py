import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farelens.functions import derive
from farelens.operators import rules
from farelens.operators.marts import batch_streaming_comparison
from farelens.operators.scorecard import freshness
from farelens.sources.readers import read_event_stream
from farelens.sources.schemas import STREAM_CLEAN, STREAM_QUARANTINE
from farelens.streaming.events import CLEAN, DEAD, QUARANTINE, assign_route, parse_events, validate_events
from farelens.streaming.job import StreamOptions, run_stream, table_rows, write_routed
from farelens.streaming.storage import compact_stream, create_stream_tables, read_stream_table, remove_covered

GOOD = {
    "event_id": "e1",
    "event_time": "2026-06-06T10:00:00+00:00",
    "ingestion_time": "2020-01-01T00:00:00+00:00",
    "vendor_id": 2,
    "rate_code_id": 1.0,
    "passenger_count": 1,
    "trip_type": 1,
    "payment_type": 2,
    "pickup_datetime": "2026-06-06T10:00:00+00:00",
    "dropoff_datetime": "2026-06-06T10:03:30+00:00",
    "store_and_fwd_flag": "Y",
    "pu_location_id": 10,
    "do_location_id": 11,
    "trip_distance": 1.5,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 0.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "congestion_surcharge": 2.75,
    "cbd_congestion_fee": 0.75,
    "total_amount": 15.5,
    "unknown_field": "dropped",
}


def message(**changes):
    return json.dumps({**GOOD, **changes})


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.txt").write_text("\n".join(lines) + "\n")


def run(spark, root, **options):
    options = StreamOptions(trigger={"availableNow": True}, **options)
    query = run_stream(read_event_stream(spark, str(root / "in"), 1), str(root / "out"), str(root / "state"), options)
    query.awaitTermination()


def rows(spark, root, table):
    return read_stream_table(spark, str(root / "out"), table).collect()


def test_routing_and_derived_columns(spark, tmp_path):
    put(tmp_path / "in", "a", message(), message(event_id="e2", trip_distance=None), "junk", message(event_id=None))
    run(spark, tmp_path)
    (clean,) = rows(spark, tmp_path, CLEAN)
    assert clean.__fields__ == STREAM_CLEAN.fieldNames()
    assert (clean["rate_code_id"], clean["trip_duration_minutes"], clean["pickup_hour"]) == (1, 4, 10)
    assert (clean["pickup_day_name"], clean["is_weekend"], clean["time_period"]) == ("Saturday", True, "Morning")
    assert (clean["payment_label"], clean["store_and_fwd_flag_label"]) == ("Cash", None)
    assert clean["_data_source"] == "streaming" and clean["ingestion_time"].year >= 2024
    (bad,) = rows(spark, tmp_path, QUARANTINE)
    assert bad.__fields__ == STREAM_QUARANTINE.fieldNames()
    assert (bad["quarantine_reason"], bad["is_valid"], bad["amount_mismatch"]) == ("invalid_distance", False, True)
    assert sorted(r["error"] for r in rows(spark, tmp_path, DEAD)) == ["malformed_message", "missing_required_field"]


def test_filled_labels_and_component_list(spark, tmp_path):
    put(tmp_path / "in", "a", message(), message(event_id="e2", trip_distance=None))
    run(spark, tmp_path, fill_labels=True, components=rules.BATCH_COMPONENTS)
    assert rows(spark, tmp_path, CLEAN)[0]["store_and_fwd_flag_label"] == "Store and Forward"
    assert rows(spark, tmp_path, QUARANTINE)[0]["amount_mismatch"] is False


DEAD_LETTERS = {
    "junk": "malformed_message",
    "": "malformed_message",
    "[1]": "malformed_message",
    "null": "malformed_message",
    "5": "malformed_message",
    '{"trip_distance":"x"}': "malformed_message",
    '{"a":1}{"b":2}': "malformed_message",
    '{"a":1} tail': "malformed_message",
    '{"a":1},"end":1': "malformed_message",
    '{"a":1': "malformed_message",
    '{"vendor_id":1.5}': "not_a_whole_number",
    '{"vendor_id":1e30}': "not_a_whole_number",
    '{"pickup_datetime":"soon"}': "unreadable_time",
    '{"event_time":""}': None,
    "{}": None,
}


@pytest.mark.parametrize("text", DEAD_LETTERS)
def test_parse_errors(spark, text):
    parsed = parse_events(spark.createDataFrame([(text,)], "value string"))
    assert [r["error"] for r in parsed.collect()] == [DEAD_LETTERS[text]]


def test_invalid_encoding(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b'{"event_id":"\xff"}\n')
    run(spark, tmp_path)
    assert [r["error"] for r in rows(spark, tmp_path, DEAD)] == ["invalid_encoding"]


def test_repeats_are_kept_by_default(spark, tmp_path):
    put(tmp_path / "in", "a", message(), message())
    run(spark, tmp_path)
    assert len(rows(spark, tmp_path, CLEAN)) == 2


@pytest.mark.parametrize("mode", ["table", "watermark"])
def test_dedupe_within_and_across_batches(spark, tmp_path, mode):
    put(tmp_path / "in", "a", message(), message(), message(event_id="e2"), "junk", "junk", message(event_id=None), message(event_id=None))
    run(spark, tmp_path, dedupe=mode)
    put(tmp_path / "in", "b", message(), message(event_id="e3"), message(event_id="bad", trip_distance=None))
    run(spark, tmp_path, dedupe=mode)
    put(tmp_path / "in", "c", message(event_id="bad", trip_distance=None), "junk")
    run(spark, tmp_path, dedupe=mode)
    assert sorted(r["event_id"] for r in rows(spark, tmp_path, CLEAN)) == ["e1", "e2", "e3"]
    assert [r["event_id"] for r in rows(spark, tmp_path, QUARANTINE)] == ["bad"]
    assert len(rows(spark, tmp_path, DEAD)) == 5


def test_table_dedupe_keeps_late_events(spark, tmp_path):
    late = {"event_time": "2026-01-01T00:00:00+00:00", "event_id": "late"}
    put(tmp_path / "in", "a", message())
    run(spark, tmp_path, dedupe="table")
    put(tmp_path / "in", "b", message(**late), message(**late))
    run(spark, tmp_path, dedupe="table")
    assert sorted(r["event_id"] for r in rows(spark, tmp_path, CLEAN)) == ["e1", "late"]


def test_late_events_become_dead_letters(spark, tmp_path):
    at = lambda day, key: message(event_time=f"2026-06-{day:02d}T10:00:00+00:00", event_id=key)
    put(tmp_path / "in", "a", at(10, "first"), at(2, "old, but in the first batch"))
    run(spark, tmp_path, dedupe="watermark", watermark="3 days")
    put(tmp_path / "in", "b", at(8, "in time"), at(6, "late"), at(6, "late"), at(10, "first"), "junk")
    run(spark, tmp_path, dedupe="watermark", watermark="3 days")
    put(tmp_path / "in", "c", at(7, "at the mark"), at(2, "late again"))
    run(spark, tmp_path, dedupe="watermark", watermark="3 days")
    assert sorted(r["event_id"] for r in rows(spark, tmp_path, CLEAN)) == ["at the mark", "first", "in time", "old, but in the first batch"]
    dead = sorted((r["error"], json.loads(r["value"])["event_id"] if r["error"] == "late_event" else r["value"]) for r in rows(spark, tmp_path, DEAD))
    assert dead == [("late_event", "late"), ("late_event", "late"), ("late_event", "late again"), ("malformed_message", "junk")]


def test_replay_of_a_batch_with_late_events(spark, tmp_path):
    out, options = str(tmp_path / "out"), StreamOptions(dedupe="watermark", watermark="1 day")
    create_stream_tables(spark, out)
    judged = lambda *lines: assign_route(validate_events(parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))))
    write_routed(judged(message()), "q", 0, out, options)
    for _ in range(2):
        write_routed(judged(message(event_id="e2", event_time="2026-07-01T00:00:00+00:00"), message(event_id="e3", event_time="2026-06-06T09:00:00+00:00")), "q", 1, out, options)
    assert sorted(r["event_id"] for r in rows(spark, tmp_path, CLEAN)) == ["e1", "e2", "e3"]
    write_routed(judged(message(event_id="e4")), "q", 2, out, options)
    assert [r["error"] for r in rows(spark, tmp_path, DEAD)] == ["late_event"]


def test_compaction_is_safe_against_replays(spark, tmp_path, monkeypatch):
    from farelens.sources import versions

    out, options = str(tmp_path / "out"), StreamOptions()
    create_stream_tables(spark, out)

    def write(batch, query="q"):
        lines = [message(event_id=f"{query}{batch}"), message(event_id=f"{query}{batch}-", event_time="2026-06-07T01:00:00+00:00"), f"junk {query}{batch}"]
        write_routed(assign_route(validate_events(parse_events(spark.createDataFrame([(x,) for x in lines], "value string")))), query, batch, out, options)

    def content():
        keys = {CLEAN: "event_id", DEAD: "value"}
        return {t: sorted(r[k] for r in rows(spark, tmp_path, t)) for t, k in keys.items()}

    for k in range(4):
        write(k)
    write(0, "other")
    before = content()
    assert len(before[CLEAN]) == 10 and len(before[DEAD]) == 5
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact_stream(spark, out, CLEAN)
    assert content() == before
    for table in (CLEAN, DEAD):
        assert compact_stream(spark, out, table) > 0
        assert content() == before
    write(3)  # the newest batch is replayed after compaction
    assert content() == before
    for table in (CLEAN, DEAD):
        assert remove_covered(spark, out, table) > 0 == remove_covered(spark, out, table)
    assert content() == before
    days = list((tmp_path / "out" / CLEAN).glob("event_date=*"))
    assert all(len(list(d.glob("query_id=*/batch_id=*"))) <= 2 for d in days)  # one a query
    write(4)
    compact_stream(spark, out, CLEAN)
    after = content()
    assert len(after[CLEAN]) == 12 and compact_stream(spark, out, CLEAN) == 0
    some = read_stream_table(spark, out, CLEAN, ["2026-06-07", "2020-01-01"])
    assert {r["event_id"] for r in some.collect()} == {x for x in after[CLEAN] if x.endswith("-")}


@pytest.mark.parametrize("dedupe", [None, "table"])
def test_replay_of_a_batch_changes_nothing(spark, tmp_path, dedupe):
    out = str(tmp_path / "out")
    create_stream_tables(spark, out)
    options = StreamOptions(dedupe=dedupe)
    lines = [message(), message(event_id="e2", trip_distance=-1.0), "junk"]
    batch = assign_route(validate_events(parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))))
    for _ in range(2):
        write_routed(batch, "q", 0, out, options)
    write_routed(batch.filter("false"), "q", 1, out, options)
    for table in (CLEAN, QUARANTINE, DEAD):
        assert read_stream_table(spark, out, table).count() == 1


def test_a_new_query_does_not_overwrite_an_old_one(spark, tmp_path):
    put(tmp_path / "in", "a", message())
    run(spark, tmp_path)
    query = run_stream(
        read_event_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "other"),
        StreamOptions(trigger={"availableNow": True}),
    )
    query.awaitTermination()
    assert len(rows(spark, tmp_path, CLEAN)) == 2


def test_stream_equals_batch_rules(spark, tmp_path):
    changes = [
        {},
        {"trip_distance": None},
        {"passenger_count": None},
        {"total_amount": None},
        {"pu_location_id": 264},
        {"fare_amount": -1.0, "do_location_id": None},
        {"cbd_congestion_fee": None},
    ]
    lines = [message(event_id=str(i), **c) for i, c in enumerate(changes)]
    put(tmp_path / "in", "a", *lines)
    run(spark, tmp_path)
    columns = ["event_id", *rules.RULE_NAMES, "amount_mismatch", "quarantine_reason"]
    streamed = read_stream_table(spark, str(tmp_path / "out"), QUARANTINE).select(*columns)
    batch = parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    flagged = rules.apply_rules(batch, components=rules.STREAM_COMPONENTS, null_policy="strict")
    judged = rules.judge(flagged, rules.validity_rules(), duplicates=False).filter("is_valid = false").select(*columns)
    assert streamed.exceptAll(judged).count() == judged.exceptAll(streamed).count() == 0
    assert streamed.count() == 5


def test_comparison_mart_leaves_out_an_empty_side(spark):
    events = validate_events(parse_events(spark.createDataFrame([(message(),)], "value string")))
    stream = table_rows(assign_route(events), CLEAN, StreamOptions())
    batch = stream.withColumn("_data_source", F.lit(None).cast("string")).filter("false")
    assert [tuple(r)[:4] for r in batch_streaming_comparison(batch, stream).collect()] == [("streaming", 1, 1.5, 10.0)]
    both = batch_streaming_comparison(stream.withColumn("_data_source", F.lit(None).cast("string")), stream)
    assert sorted(r["data_source"] for r in both.collect()) == ["batch", "streaming"]


@pytest.mark.parametrize("minutes, status", [(15, "pass"), (16, "warn"), (60, "warn"), (61, "error"), (None, "error")])
def test_freshness(spark, minutes, status):
    now = F.lit("2026-06-01 12:00:00").cast("timestamp")
    df = spark.createDataFrame([(datetime(2026, 6, 1, 12),)], "ingestion_time timestamp")
    df = df.filter("false") if minutes is None else df.withColumn("ingestion_time", F.expr(f"ingestion_time - interval {minutes} minutes"))
    assert freshness(df, now=now).first()["status"] == status


def test_batch_and_stream_durations_differ(spark):
    df = spark.sql("select timestamp'2026-06-01 10:00:00' a, timestamp'2026-06-01 10:59:59' b")
    row = df.select(derive.whole_minutes(F.col("a"), F.col("b")), derive.rounded_minutes(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (59, 60)


def judged_rows(spark, *lines):
    return assign_route(validate_events(parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))))


def test_compaction_leaves_compacted_rows_alone(spark, tmp_path, monkeypatch):
    from farelens.sources.versions import read_manifest
    from farelens.streaming import storage

    monkeypatch.setattr(storage, "MOST_VERSIONS", 3)
    out, files = str(tmp_path / "out"), []
    create_stream_tables(spark, out)
    for k in range(6):
        write_routed(judged_rows(spark, message(event_id=f"e{k}")), "q", k, out, StreamOptions())
        compact_stream(spark, out, CLEAN)
        files.append({p for p in (tmp_path / "out" / "clean_compacted").rglob("*.parquet")})
        assert sorted(r["event_id"] for r in rows(spark, tmp_path, CLEAN)) == [f"e{i}" for i in range(k + 1)]
    assert files[1] < files[2]  # the second compaction of the day only adds a file
    assert len({p.parts[-3] for p in files[3]}) == 3
    # The fourth one writes the day anew, the fifth one adds to it again.
    assert read_manifest(spark, f"{out}/clean_compacted")[1]["part=2026-06-06"].count(",") == 1


def test_only_repeated_events_are_compared(spark, tmp_path, monkeypatch):
    from farelens.streaming import job

    stored = {}
    monkeypatch.setattr(job, "materialize", lambda df, name: stored.setdefault(name, df.localCheckpoint()))
    out = str(tmp_path / "out")
    create_stream_tables(spark, out)
    lines = [message(event_id="a"), message(event_id="b"), message(event_id="b", trip_distance=9.0), message(event_id="b", trip_distance=-1.0), "junk", "junk"]
    write_routed(judged_rows(spark, *lines), "q", 0, out, StreamOptions(dedupe="table"))
    assert [r["event_id"] for r in stored["least-events"].collect()] == ["b"]
    assert [(r["event_id"], r["trip_distance"]) for r in rows(spark, tmp_path, QUARANTINE)] == [("b", -1.0)]
    assert [r["event_id"] for r in rows(spark, tmp_path, CLEAN)] == ["a"]
    assert len(rows(spark, tmp_path, DEAD)) == 2
