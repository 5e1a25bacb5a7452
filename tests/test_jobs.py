import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gatewatch.config import PipelineConfig, RiskConfig, TablePaths
from gatewatch.plans import analytics, jobs
from gatewatch.plans.curated import build_curated, build_raw, build_wide
from gatewatch.plans.tables import create_tables, insert_features, register_partitions
from gatewatch.operators.features import compute_rolling_windows
from gatewatch.sources import tables as scans
from helpers import event, frame, skewed_events

CFG = PipelineConfig(
    risk=RiskConfig(
        lateral_movement_unique_hosts_1h=2, burst_login_event_count_1h=2, new_device_spike_unique_hosts_24h=4
    )
)
FIRST, LAST = date(2024, 3, 1), date(2024, 3, 5)


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def events(spark):
    rows = skewed_events(300)
    return frame(spark, rows + [(r[0] + timedelta(seconds=9), *r[1:]) for r in rows[:40]])


@pytest.fixture
def lake(events, folder):
    paths = TablePaths(folder)
    jobs.ingest(events, paths)
    return paths


def test_raw_table_is_deduplicated(spark, events, lake):
    assert same(scans.raw_events(spark, lake), build_raw(events))
    assert sorted(d for d in os.listdir(lake.raw) if d.startswith("event_date="))[0] == "event_date=2024-03-01"


def test_backfill_of_a_part_equals_the_whole_build(spark, events, lake):
    whole = build_curated(events, CFG)
    for stored in (False, True):
        if stored:
            for day in (1, 2, 2, 3, 4):
                jobs.merge_history(spark, lake, date(2024, 3, day), date(2024, 3, day + 1))
        jobs.backfill(spark, lake, date(2024, 3, 3), date(2024, 3, 4), CFG, stored_history=stored)
        assert same(scans.curated_events(spark, lake), whole.filter("event_date = '2024-03-03'"))
    jobs.backfill(spark, lake, FIRST, LAST, CFG)
    assert same(scans.curated_events(spark, lake), whole)


def test_refresh_is_idempotent_and_drops_emptied_days(spark, lake):
    jobs.backfill(spark, lake, FIRST, LAST, CFG)
    before = sorted(map(tuple, scans.user_behavior_hourly(spark, lake).collect()))
    jobs.run_daily(spark, lake, FIRST, LAST)
    assert sorted(map(tuple, scans.user_behavior_hourly(spark, lake).collect())) == before
    assert scans.user_behavior_hourly(spark, lake).agg(F.sum("event_count")).first()[0] == 300

    # The source loses a day: refreshing the range must lose it too, and nothing else.
    gone = "2024-03-02"
    jobs.refresh_days(
        scans.curated_events(spark, lake).limit(0), lake.curated, ["event_date"], date(2024, 3, 2), date(2024, 3, 3)
    )
    jobs.run_daily(spark, lake, FIRST, LAST)
    left = scans.user_behavior_hourly(spark, lake)
    assert sorted(map(tuple, left.collect())) == [r for r in before if gone not in map(str, r)]
    days = {str(r.event_date) for r in scans.host_popularity_daily(spark, lake).collect()}
    assert days == {"2024-03-01", "2024-03-03", "2024-03-04"}


def test_refresh_leaves_other_window_sizes(spark, lake):
    jobs.backfill(spark, lake, FIRST, LAST, CFG)
    other = scans.user_behavior_hourly(spark, lake).limit(3).withColumn("window_size", F.lit("24h"))
    other.withColumn("event_date", F.lit("2024-03-02")).write.mode("append").partitionBy(
        "event_date", "window_size"
    ).parquet(lake.user_behavior_hourly)
    jobs.run_daily(spark, lake, FIRST, LAST)
    assert scans.user_behavior_hourly(spark, lake).filter("window_size = '24h'").count() == 3


def test_date_ranges(spark, lake):
    with pytest.raises(ValueError):
        jobs.run_daily(spark, lake, LAST, FIRST)
    assert jobs.default_range(date(2024, 3, 2)) == (date(2024, 3, 1), date(2024, 3, 2))


def test_day_predicate_prunes_partitions(spark, lake):
    from gatewatch.functions.times import within_days

    plan = (
        scans.raw_events(spark, lake)
        .filter(within_days(date(2024, 3, 2), date(2024, 3, 3)))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-03-02" in plan


def test_catalog_tables(spark, events, lake):
    jobs.backfill(spark, lake, FIRST, LAST, CFG)
    insert_features(compute_rolling_windows(events), lake.features)
    create_tables(spark, lake, "gatewatch_test")
    try:
        register_partitions(spark, lake, "gatewatch_test")
        counted = spark.table("gatewatch_test.auth_events_curated")
        assert counted.count() == scans.curated_events(spark, lake).count()
        assert spark.table("gatewatch_test.auth_user_features").filter("window_size = '24h'").count() > 0
        assert spark.table("gatewatch_test.host_popularity_daily").schema["event_date"].dataType.simpleString() == "date"
    finally:
        spark.sql("DROP DATABASE gatewatch_test CASCADE")


def test_wide_and_curated_keep_every_event(events):
    popularity = PipelineConfig(risk=RiskConfig(rare_host_mode="popularity"))
    assert build_wide(events, CFG).count() == build_curated(events, popularity).count() == 300


def test_blank_ids_are_left_out(spark):
    rows = [event(1), event(2, user=" "), event(3, host=""), event(4, host="C2")]
    assert build_curated(frame(spark, rows)).count() == 2


def test_ingesting_again_changes_nothing(spark, events, lake):
    jobs.ingest(events, lake)
    jobs.ingest(events.filter("user_id = 'U0'").withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 HOUR")), lake)
    assert same(scans.raw_events(spark, lake), build_raw(events))
    jobs.ingest(events.limit(0), lake)
    more = frame(spark, [event(5, "U7", "C7", "more"), event(86400 * 3, "U0", "C0", "e0001")])
    jobs.ingest(more, lake)
    known = {r.event_id for r in build_raw(events).collect()}
    assert {r.event_id for r in scans.raw_events(spark, lake).collect()} == known | {"more"}


def test_events_without_ids_stay(spark):
    rows = [event(0, "U1", "C1"), event(1, "U1", "C1"), event(0, "U2", "C1"), event(0, "U2", "C1")]
    nameless = frame(spark, rows).withColumn("event_id", F.lit(None).cast("string"))
    assert build_raw(nameless).count() == 3
    assert build_raw(nameless.withColumn("event_id", F.lit(" "))).select("event_id").distinct().count() == 3


def test_reports_that_look_back_read_few_days(spark, events, lake):
    jobs.backfill(spark, lake, FIRST, LAST, CFG)
    curated = scans.curated_events(spark, lake)
    for report in (analytics.high_risk_events, analytics.high_risk_users_last_hour, analytics.high_risk_users):
        plan = report(curated, F.lit("2024-03-04 12:00:00").cast("timestamp"))._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(event_date" in plan
