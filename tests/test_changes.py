from datetime import date

import pytest
from pyspark.sql import functions as F

from gatewatch.config import PipelineConfig, RiskConfig, TablePaths
from gatewatch.operators.features import window_features
from gatewatch.operators.firstseen import flag_new_devices, seen_pairs
from gatewatch.operators.rollups import host_risk_daily, user_risk_hourly
from gatewatch.plans import changes, jobs
from gatewatch.plans.curated import build_curated, build_wide
from gatewatch.plans.history import fold_pairs, known_pairs, stored_pairs
from gatewatch.sources import tables as scans
from helpers import event, frame, skewed_events

CFG = PipelineConfig(
    risk=RiskConfig(lateral_movement_unique_hosts_1h=2, burst_login_event_count_1h=2, new_device_spike_unique_hosts_24h=4)
)


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def stored_equals_built(spark, paths, events):
    wide = build_wide(events, CFG)
    assert same(scans.curated_events(spark, paths), build_curated(events, CFG))
    assert same(scans.wide_events(spark, paths), wide)
    assert same(scans.features(spark, paths), window_features(events, [CFG.hour_hop, CFG.day_hop]))
    assert same(scans.user_risk_hourly(spark, paths).drop("event_date"), user_risk_hourly(wide))
    assert same(scans.host_risk_daily(spark, paths).drop("event_date"), host_risk_daily(wide))
    assert same(known_pairs(spark, paths), seen_pairs(events))


def test_only_touched_days_are_built_and_all_tables_agree(spark, folder, monkeypatch):
    rows = sorted(skewed_events(150), key=lambda r: (r[0], r[5]))
    # The second delivery holds a later day, and an early event that was someone's first.
    first, second = rows[:100], rows[100:] + [event(5, "U3", "C0", "early"), event(20 * 86400, "U1", "C1", "far")]
    paths = TablePaths(folder)
    jobs.ingest(frame(spark, first), paths)
    assert len(changes.refresh_changed(spark, paths, CFG)) > 1
    stored_equals_built(spark, paths, frame(spark, first))
    assert changes.refresh_changed(spark, paths, CFG) == []

    built = []
    whole = jobs.backfill
    monkeypatch.setattr(jobs, "backfill", lambda s, t, start, end, *a, **k: (built.append((start, end)), whole(s, t, start, end, *a, **k)))
    jobs.ingest(frame(spark, second), paths)
    touched = changes.refresh_changed(spark, paths, CFG)
    stored_equals_built(spark, paths, frame(spark, first + second))
    assert date(2024, 3, 21) in touched and (date(2024, 3, 21), date(2024, 3, 23)) in built


def test_a_run_that_died_is_repeated(spark, folder, monkeypatch):
    rows = [event(86400 * 3, "U1", "C1", "late"), event(86400 * 3 + 60, "U2", "C1", "b")]
    paths = TablePaths(folder)
    jobs.ingest(frame(spark, rows), paths)
    changes.refresh_changed(spark, paths, CFG)
    # An earlier event takes the mark of the first from an event of another day; the run dies after the merge.
    earlier = event(0, "U1", "C1", "early")
    jobs.ingest(frame(spark, [earlier]), paths)
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "backfill", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            changes.refresh_changed(spark, paths, CFG)
    assert changes.refresh_changed(spark, paths, CFG) == [date(2024, 3, 1)]
    stored_equals_built(spark, paths, frame(spark, [*rows, earlier]))


def test_history_stays_where_it_is(spark, folder):
    """No exchange above the scan of the history, neither in a merge nor in a join with a day's events."""
    events = frame(spark, skewed_events(80))
    paths = TablePaths(folder)
    jobs.ingest(events, paths)
    jobs.merge_history(spark, paths, date(2024, 3, 1), date(2024, 3, 3))
    jobs.merge_history(spark, paths, date(2024, 3, 2), date(2024, 3, 5))
    assert stored_pairs(spark, paths).count() > known_pairs(spark, paths).count()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for plan in (
            known_pairs(spark, paths),
            window_features(events, [CFG.hour_hop, CFG.day_hop], known_pairs(spark, paths)),
            flag_new_devices(events, known_pairs(spark, paths)),
        ):
            assert not exchanged_scans(plan, "pair_history"), plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def exchanged_scans(df, path):
    """Exchanges whose input reads the history and has not joined it to anything yet."""
    found = []

    def walk(node):
        if "Exchange" in node.nodeName() and path in node.toString() and "Join" not in node.toString():
            found.append(node.toString())
        for child in [node.inputPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_folding_keeps_every_pair(spark, folder):
    events = frame(spark, skewed_events(80))
    paths = TablePaths(folder)
    jobs.ingest(events, paths)
    for day in (1, 3, 2, 4, 2):
        jobs.merge_history(spark, paths, date(2024, 3, day), date(2024, 3, day + 1))
    before = sorted(map(tuple, known_pairs(spark, paths).collect()))
    fold_pairs(spark, paths)
    assert sorted(map(tuple, known_pairs(spark, paths).collect())) == before
    assert stored_pairs(spark, paths).count() == len(before) == seen_pairs(events).count()
    jobs.merge_history(spark, paths, date(2024, 3, 1), date(2024, 3, 5))
    assert sorted(map(tuple, known_pairs(spark, paths).collect())) == before


def test_runs_of_days():
    days = [date(2024, 3, d) for d in (5, 1, 2, 2, 9)]
    assert changes.runs(days) == [(date(2024, 3, 1), date(2024, 3, 3)), (date(2024, 3, 5), date(2024, 3, 6)), (date(2024, 3, 9), date(2024, 3, 10))]
    assert changes.runs([]) == []


def test_stored_key_figures_read_the_days_they_speak_of(spark, folder):
    paths = TablePaths(folder)
    jobs.ingest(frame(spark, skewed_events(60)), paths)
    changes.refresh_changed(spark, paths, CFG)
    wide = scans.wide_events(spark, paths).filter(F.col("event_date") == "2024-03-02")
    assert "PartitionFilters: [isnotnull(event_date" in wide._jdf.queryExecution().executedPlan().toString()
