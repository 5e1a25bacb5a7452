import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gatewatch import schemas
from gatewatch.config import DAY_HOP, HOUR_HOP, HopSpec, PipelineConfig, RiskConfig, StreamConfig, TablePaths
from gatewatch.operators.features import window_features
from gatewatch.operators.firstseen import flag_new_devices, seen_pairs
from gatewatch.operators.rolling import rolling_activity
from gatewatch.operators.rollups import host_access_daily
from gatewatch.plans.curated import build_curated
from gatewatch.plans.kpis import alarm_minutes, low_volume_alarm, minute_lag, missing_dates
from gatewatch.plans.tables import refresh_days
from gatewatch.sources import tables as scans
from gatewatch.streaming import pipeline, replay, tail
from gatewatch.streaming.alarms import lag_stream, low_volume_stream
from gatewatch.streaming.commits import complete_days
from gatewatch.streaming.features import stream_features
from gatewatch.streaming.firstseen import flag_new_devices_stream
from gatewatch.streaming.rolling import rolling_stream
from gatewatch.streaming.sources import source_options, start_position
from helpers import START, event, frame, skewed_events

RISK = RiskConfig(lateral_movement_unique_hosts_1h=2, burst_login_event_count_1h=2, new_device_spike_unique_hosts_24h=4)


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def payload(row):
    time, user, _, host, success, name = row
    body = {"event_time": time.isoformat(), "user_id": user, "computer_id": host, "event_id": name, "success": success}
    return json.dumps(body)


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    hidden = os.path.join(folder, f".{name}")
    with open(hidden, "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")
    # Files are taken in the order of their times.
    os.utime(hidden, (1_700_000_000 + int(name),) * 2)
    os.rename(hidden, os.path.join(folder, name))


def config(folder, **options):
    stream = StreamConfig(
        source_format="text", source_path=f"{folder}/in", trigger_once=True, state_shards=8, **options
    )
    return PipelineConfig(risk=RISK, tables=TablePaths(f"{folder}/lake"), stream=stream)


def test_pipeline_equals_batch_over_restarts(spark, folder):
    rows = sorted(skewed_events(240), key=lambda r: (r[0], r[5]))
    end = event(6 * 86400, "U9", "C9", "end")
    duplicates = [(r[0] + timedelta(seconds=1), *r[1:]) for r in rows[:5]]
    late = event(1, "U1", "C1", "late")
    cfg = config(folder)
    write_lines(f"{folder}/in", "1", [payload(r) for r in rows[:120] + duplicates] + ["{broken", '{"user_id": "U1"}'])
    pipeline.start_pipeline(spark, cfg)
    write_lines(f"{folder}/in", "2", [payload(r) for r in rows[120:] + [late]] + [payload(event(9, host=" "))])
    pipeline.start_pipeline(spark, cfg)
    write_lines(f"{folder}/in", "3", [payload(end)])
    pipeline.start_pipeline(spark, cfg)

    events = frame(spark, rows + [end])
    stored = spark.read.schema(schemas.RAW_STORED).parquet(cfg.tables.raw)
    flagged = flag_new_devices(events).select("event_id", "event_time", "is_new_device")
    assert same(stored.select(*flagged.columns), flagged)

    closed = F.lit(end[0] - timedelta(minutes=5))
    features = window_features(events, [HOUR_HOP, DAY_HOP]).filter(F.col("window_end") <= closed)
    assert same(scans.features(spark, cfg.tables), features)
    curated = build_curated(events, cfg).filter("user_id <> 'U9'")
    assert same(scans.curated_events(spark, cfg.tables), curated)

    # With the open tail nothing is missing.
    whole = build_curated(events, cfg)
    assert same(tail.complete_curated(spark, cfg), whole)
    assert same(tail.complete_features(spark, cfg), window_features(events, [HOUR_HOP, DAY_HOP]))

    rejected = spark.read.parquet(cfg.tables.dead_letters)
    assert sorted(r.reject_reason for r in rejected.collect()) == [
        "blank_computer_id",
        "malformed_json",
        "missing_event_time",
    ]
    assert "processing_time" in rejected.columns

    pipeline.start_host_popularity(spark, cfg).awaitTermination()
    popularity = spark.read.schema(schemas.HOST_POPULARITY_RAW).parquet(
        cfg.tables.path("aggregates/host_access_daily")
    )
    assert same(popularity, host_access_daily(events))

    with pytest.raises(ValueError):
        refresh_days(curated, cfg.tables.curated, ["event_date"], START.date(), end[0].date())


def test_csv_payloads_and_rate_bounds(spark, folder):
    cfg = config(folder, payload_format="csv", max_files_per_trigger=1)
    for n in range(3):
        write_lines(f"{folder}/in", str(n), [f"{1000 * n + k + 1},U{k},C{k % 2}" for k in range(4)] + ["x,U1,C1"])
    queries = pipeline.start_ingest(spark, cfg)
    for query in queries:
        query.awaitTermination()
    assert len([p for p in queries[0].recentProgress if p.numInputRows]) == 3
    stored = spark.read.schema(schemas.RAW_STORED).parquet(cfg.tables.raw)
    assert stored.count() == 12 and stored.filter("is_new_device").count() == 4
    assert stored.filter("event_id = '2004-U3-C1' AND success AND NOT is_new_device").count() == 1
    assert spark.read.parquet(cfg.tables.dead_letters).count() == 3


def drain(spark, stream, folder, name):
    query = pipeline.start_sink(stream, f"{folder}/{name}", [], f"{folder}/c_{name}", StreamConfig(trigger_once=True))
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}")


def files(spark, folder, batches, watermark="5 minutes"):
    """A stream of event files, one micro-batch each, with each file's order kept; None: without a watermark."""
    for n, rows in enumerate(batches):
        frame(spark, rows).coalesce(1).write.parquet(f"{folder}/src/{n:02d}")
    read = spark.readStream.schema(schemas.EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/src/*")
    return read if watermark is None else read.withWatermark("event_time", watermark)


def test_state_with_ttl_equals_batch(spark, folder):
    rows = sorted(skewed_events(200), key=lambda r: (r[0], r[5]))
    batches = [rows[n : n + 40] for n in range(0, 200, 40)]
    stream = flag_new_devices_stream(files(spark, folder, batches), shards=4, ttl="6 hours")
    got = drain(spark, stream, folder, "out").select("event_id", "is_new_device")
    want = flag_new_devices(frame(spark, rows), ttl="6 hours").select("event_id", "is_new_device")
    assert same(got, want)
    assert 0 < got.filter("is_new_device").count() < 200


def test_state_seeded_from_history(spark, folder):
    rows = sorted(skewed_events(160), key=lambda r: (r[0], r[5]))
    early, later = rows[:80], rows[80:]
    history = seen_pairs(frame(spark, early))
    stream = flag_new_devices_stream(files(spark, folder, [later[:40], later[40:]]), shards=4, history=history)
    got = drain(spark, stream, folder, "out").select("event_id", "is_new_device")
    want = flag_new_devices(frame(spark, later), history).select("event_id", "is_new_device")
    assert same(got, want)


def test_state_seeded_from_history_with_ttl(spark, folder):
    day = 86400
    history = seen_pairs(frame(spark, [event(0), event(day * 9), event(0, "U2", "C2")]))
    rows = [event(day * 10), event(day * 10 + 1, "U2", "C2"), event(day * 20)]
    stream = flag_new_devices_stream(files(spark, folder, [rows[:2], rows[2:]]), shards=2, ttl="3 days", history=history)
    got = drain(spark, stream, folder, "out").select("event_id", "is_new_device")
    assert same(got, flag_new_devices(frame(spark, rows), history, ttl="3 days").select("event_id", "is_new_device"))


def test_popularity_mode_is_refused_on_streams(spark, folder):
    cfg = PipelineConfig(risk=RiskConfig(rare_host_mode="popularity"), tables=TablePaths(folder))
    with pytest.raises(ValueError):
        pipeline.start_pipeline(spark, cfg)


def test_join_state_is_keyed_by_slot(spark, folder):
    """Both stream-stream joins shuffle on user and slot, so a busy user is spread."""
    rows = skewed_events(40)
    stream = files(spark, folder, [rows]).withWatermark("event_time", "5 minutes").withColumn("is_new_device", F.lit(False))
    plan = pipeline.curated_stream(stream, PipelineConfig())._jdf.queryExecution().analyzed().toString()
    assert "_slot_1h" in plan and "_slot_24h" in plan


def test_start_positions():
    assert start_position("TRIM_HORIZON") == "earliest" and start_position("LATEST") == "latest"
    with pytest.raises(ValueError):
        start_position("middle")
    kafka = StreamConfig(source_format="kafka", start_from="earliest", max_offsets_per_trigger=10)
    assert source_options(kafka) == {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "10"}


def test_ttl_state_is_forgotten_by_bucket(spark, folder):
    """Pairs leave the state once they have expired, and a pair seen again stays."""
    hour = 3600
    rows = [[event(n * 60, f"U{n}", "C1") for n in range(20)], [event(5 * hour, "U1", "C1")], [event(9 * hour, "U99", "C1")], [event(12 * hour, "U1", "C1")], [event(30 * hour, "U5", "C1")], [event(31 * hour, "U5", "C1")]]
    stream = flag_new_devices_stream(files(spark, folder, rows), shards=1, ttl="6 hours")
    query = pipeline.start_sink(stream, f"{folder}/out", [], f"{folder}/c", StreamConfig(trigger_once=True))
    query.awaitTermination()
    flat = [r for batch in rows for r in batch]
    want = flag_new_devices(frame(spark, flat), ttl="6 hours").select("event_id", "is_new_device")
    assert same(spark.read.parquet(f"{folder}/out").select("event_id", "is_new_device"), want)
    left = spark.read.format("statestore").option("stateVarName", "pairs").load(f"{folder}/c")
    users = {r.key_user for r in left.select("user_map_key.user_id").withColumnRenamed("user_id", "key_user").collect()}
    assert "U3" not in users and "U5" in users


def test_hosts_of_a_user_are_few_rows_of_state(spark, folder):
    """Calls to the state follow users, not pairs; pairs of many buckets that expire at once go together."""
    day = 86400
    rows = [event(n * 3600, "U1", f"C{n}") for n in range(48)] + [event(n, "U2", f"C{n}") for n in range(30)]
    batches = [rows, [event(20 * day, "U1", "C1")], [event(21 * day, "U1", "C99")], [event(22 * day, "U1", "C1")]]
    flat = [r for batch in batches for r in batch]
    for ttl, most in (("3 days", 2), (None, 8)):
        place = f"{folder}/{most}"
        got = drain(spark, flag_new_devices_stream(files(spark, place, batches), shards=4, ttl=ttl), place, "out")
        assert same(got.select("event_id", "is_new_device"), flag_new_devices(frame(spark, flat), ttl=ttl).select("event_id", "is_new_device"))
        left = spark.read.format("statestore").option("stateVarName", "pairs").load(f"{place}/c_out")
        assert 0 < left.count() <= most


def test_many_rows_of_few_pairs_pass_through(spark, folder):
    """Rows of a shard come in several portions; the earliest event of a pair may be in any of them."""
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "7")
    try:
        for ttl in (None, "2 hours"):
            rows = skewed_events(90, seed=11)
            stream = flag_new_devices_stream(files(spark, f"{folder}/{ttl}", [rows]), shards=2, ttl=ttl)
            got = drain(spark, stream, f"{folder}/{ttl}", "out").select("event_id", "is_new_device")
            assert same(got, flag_new_devices(frame(spark, rows), ttl=ttl).select("event_id", "is_new_device"))
    finally:
        spark.conf.set(limit, before)


def test_rolling_activity_over_micro_batches(spark, folder):
    rows = sorted(skewed_events(160), key=lambda r: (r[0], r[5]))
    batches = [rows[:50], rows[50:90], rows[90:]]
    got = drain(spark, rolling_stream(files(spark, folder, batches)), folder, "out")
    want = rolling_activity(frame(spark, rows))
    names = ["event_id", "login_count_1h", "unique_computers_1h", "login_count_24h", "unique_computers_24h"]
    # Events of one time that are in two micro-batches are the one case in which a stream cannot know better.
    assert same(got.select(*names), want.select(*names))


def test_rolling_state_is_one_row_per_user(spark, folder):
    """However many hours a micro-batch holds; a user silent for longer than a span has no row left."""
    hour = 3600
    rows = [event(n * hour, f"U{n % 2}", "C1") for n in range(40)] + [event(30 * hour, "U2", "C1"), event(0, "U3", "C1")]
    batches = [rows, [event(41 * hour, "U1", "C2")]]
    stream = rolling_stream(files(spark, folder, batches))
    got = drain(spark, stream, folder, "out")
    want = rolling_activity(frame(spark, [r for batch in batches for r in batch]))
    assert same(got, want.select(*got.columns))
    left = spark.read.format("statestore").option("stateVarName", "points").load(f"{folder}/c_out")
    assert sorted(r[0] for r in left.select("key.user_id").collect()) == ["U0", "U1", "U2"]


def test_low_volume_is_noticed_without_data(spark, folder):
    """Busy minutes, a gap over three micro-batches, busy minutes again; a second series is judged by itself."""
    busy = [event(60 * m + s, "U1", "C1", f"a{m}-{s}") for m in (0, 1, 2, 40, 41, 43, 60, 61, 62, 63, 64, 65, 66) for s in (0, 20, 40)]
    other = [event(60 * m + 1, "U2", "C1", f"b{m}") for m in (1, 3, 7, 50, 90)]
    rows = sorted(busy + other, key=lambda r: (r[0], r[5]))
    batches = [rows[:8], rows[8:12], rows[12:30], rows[30:]]
    closed = F.col("minute") < F.lit(START + timedelta(minutes=85))
    got = drain(spark, low_volume_stream(files(spark, folder, batches), 3, F.col("user_id")), folder, "out")
    for user in ("U1", "U2"):
        # A batch ends with the last data; a stream goes on, so one more busy event at the end makes them alike.
        whole = [r for r in rows if r[1] == user] + [event(60 * 90 + 1, user, "C1", "end")]
        want = low_volume_alarm(frame(spark, whole), 3).filter(closed)
        mine = got.filter(F.col("series") == user).drop("series").filter(closed)
        assert want.count() > 10 and same(mine, want)


def test_lag_alarm_of_a_stream_equals_batch(spark, folder):
    rows = [event(60 * m, f"U{m}", "C1", f"e{m}") for m in range(0, 90, 2)]
    late = F.make_dt_interval(mins=F.pmod(F.xxhash64("event_id"), F.lit(9)).cast("int"))
    stream = files(spark, folder, [rows[:20], rows[20:]], watermark=None).select("*", (F.col("event_time") + late).alias("processing_time"))
    got = drain(spark, lag_stream(stream.withWatermark("processing_time", "10 minutes"), 180, 2, 4), folder, "out").drop("series")
    batch = frame(spark, rows).select("*", (F.col("event_time") + late).alias("processing_time"))
    closed = F.col("minute") < F.lit(START + timedelta(minutes=75))
    want = alarm_minutes(minute_lag(batch), F.col("value") >= 180, 2, 4).filter(closed)
    assert want.count() > 5 and same(got.filter(closed), want)


def test_windows_that_do_not_nest_are_copied(spark, folder):
    rows = sorted(skewed_events(60), key=lambda r: (r[0], r[5])) + [event(9 * 86400, "U9", "C9", "end")]
    flagged = files(spark, folder, [rows]).withColumn("is_new_device", F.lit(False))
    hops = [HopSpec("2h", 7200, 3000), HopSpec("1h", 3600, 3600)]
    got = drain(spark, stream_features(flagged, hops), folder, "out").filter("user_id <> 'U9'")
    want = window_features(frame(spark, rows).withColumn("is_new_device", F.lit(False)), hops).filter("user_id <> 'U9'")
    assert same(got, want)


def test_source_is_read_once_and_repeated_batches_change_nothing(spark, folder):
    cfg = config(folder)
    write_lines(f"{folder}/in", "1", [payload(event(n, f"U{n}")) for n in range(6)] + ["{broken"])
    pipeline.prepare_streaming(spark)
    pipeline.start_landing(spark, cfg).awaitTermination()
    landed = spark.read.schema(schemas.LANDED).parquet(cfg.tables.landing)
    before = sorted(map(str, landed.collect()))
    rejected = spark.read.parquet(cfg.tables.dead_letters).count()
    assert len(before) == 6 and rejected == 1
    # A kill between the tables and the commit of the micro-batch: it is run again.
    os.remove(f"{folder}/lake/checkpoint/landing/commits/0")
    crc = f"{folder}/lake/checkpoint/landing/commits/.0.crc"
    if os.path.exists(crc):
        os.remove(crc)
    pipeline.start_landing(spark, cfg).awaitTermination()
    landed = spark.read.schema(schemas.LANDED).parquet(cfg.tables.landing)
    assert sorted(map(str, landed.collect())) == before
    assert spark.read.parquet(cfg.tables.dead_letters).count() == rejected


def test_days_are_marked_behind_the_watermark(spark, folder):
    cfg = config(folder, commit_delay="1 hour")
    day = 86400
    write_lines(f"{folder}/in", "1", [payload(event(n)) for n in (0, 60, day + 60)])
    pipeline.start_pipeline(spark, cfg)
    assert [r[0] for r in complete_days(spark, cfg.tables.raw).collect()] == []
    # Five minutes of watermark and one hour of delay after the end of the first day.
    write_lines(f"{folder}/in", "2", [payload(event(day + 65 * 60 + 1, host="C2"))])
    pipeline.start_pipeline(spark, cfg)
    assert [r[0] for r in complete_days(spark, cfg.tables.raw).collect()] == ["2024-03-01"]
    write_lines(f"{folder}/in", "3", [payload(event(120, host="C3", event_id="late"))])
    pipeline.start_pipeline(spark, cfg)
    stored = spark.read.schema(schemas.RAW_STORED).parquet(cfg.tables.raw)
    assert stored.filter("event_id = 'late'").isEmpty() and stored.filter("event_date = '2024-03-01'").count() == 2
    marks = missing_dates(complete_days(spark, cfg.tables.raw), START.date(), (START + timedelta(days=1)).date())
    assert [r[0] for r in marks.collect()] == ["2024-03-02"]


def test_replay_in_steps_over_a_restart(spark, folder):
    rows = skewed_events(50)
    steps = replay.stage_replay(frame(spark, rows), f"{folder}/staged", 12)
    assert steps == 5
    query = replay.start_replay(spark, f"{folder}/staged", f"{folder}/in", f"{folder}/c", steps, trigger_seconds=0.2)
    while replay.published(spark, f"{folder}/in") < 2:
        query.awaitTermination(0.1)
    query.stop()
    done = replay.published(spark, f"{folder}/in")
    query = replay.start_replay(spark, f"{folder}/staged", f"{folder}/in", f"{folder}/c", steps, trigger_seconds=0.2)
    replay.await_replay(spark, query, f"{folder}/in", steps, 120)
    assert 2 <= done <= steps == replay.published(spark, f"{folder}/in")
    sent = []
    for name in sorted(n for n in os.listdir(f"{folder}/in") if n.startswith("step-")):
        with open(f"{folder}/in/{name}", encoding="utf-8") as file:
            sent.append([json.loads(line) for line in file])
    assert [len(s) for s in sent] == [12, 12, 12, 12, 2]
    names = [e["event_id"] for s in sent for e in s]
    assert names == [r[5] for r in sorted(rows, key=lambda r: (r[0], r[5]))]
    skipped = replay.stage_replay(frame(spark, rows), f"{folder}/staged2", 12, start_at=45)
    assert skipped == 1 and spark.read.parquet(f"{folder}/staged2").count() == 5


def test_stream_with_ttl_and_its_tail_agree(spark, folder):
    rows = sorted(skewed_events(90), key=lambda r: (r[0], r[5]))
    cfg = config(folder, state_ttl="10 hours")
    write_lines(f"{folder}/in", "1", [payload(r) for r in rows])
    pipeline.start_pipeline(spark, cfg)
    events = frame(spark, rows)
    flagged = flag_new_devices(events, ttl="10 hours")
    whole = window_features(flagged, [HOUR_HOP, DAY_HOP])
    assert not same(whole, window_features(events, [HOUR_HOP, DAY_HOP]))
    assert same(tail.complete_features(spark, cfg), whole)
    assert same(tail.complete_curated(spark, cfg), build_curated(events, cfg))
