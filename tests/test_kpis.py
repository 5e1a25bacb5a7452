from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from gatewatch.plans import analytics, kpis
from helpers import event, frame

T0 = datetime(2024, 3, 1)


def series(spark, values):
    rows = [(T0 + timedelta(minutes=m), v) for m, v in values.items()]
    return spark.createDataFrame(rows, "minute timestamp, value long")


def minutes(df):
    return sorted((int((r.minute - T0).total_seconds() // 60), r.breaching_points) for r in df.collect())


def test_three_of_three_ignores_missing_minutes(spark):
    s = series(spark, {0: 400, 1: 400, 3: 400, 4: 300, 5: 301, 6: 10})
    assert minutes(kpis.alarm_minutes(s, F.col("value") >= 300, 3, 3)) == [(5, 3)]


def test_missing_minutes_can_breach(spark):
    s = series(spark, {0: 9, 1: 1, 5: 1, 6: 9, 7: 9})
    low = kpis.alarm_minutes(s, F.col("value") < 5, 5, 5, missing_breaches=True)
    assert minutes(low) == [(5, 5)]
    four_of_five = kpis.alarm_minutes(s, F.col("value") < 5, 4, 5, missing_breaches=True)
    assert minutes(four_of_five) == [(4, 4), (5, 5), (6, 4)]


def test_series_over_midnight(spark):
    s = series(spark, {1438: 1, 1442: 1})
    assert minutes(kpis.alarm_minutes(s, F.col("value") < 5, 5, 5, missing_breaches=True)) == [(1442, 5)]


def test_freshness(spark):
    rows = [(T0, T0 + timedelta(seconds=s)) for s in [*range(95), 301, 302, 303, 304, 305]]
    got = kpis.freshness(spark.createDataFrame(rows, "event_time timestamp, processing_time timestamp")).first()
    assert (got.events, got.max_lag_seconds, got.share_within_limit) == (100, 305, 0.95)
    assert round(got.p95_lag_seconds, 6) == 104.35


def test_dates_and_counts(spark):
    raw = spark.createDataFrame([("2024-03-01",)] * 3 + [("2024-03-03",)], "event_date string")
    curated = spark.createDataFrame([("2024-03-01",)] * 2 + [("2024-03-04",)], "event_date string")
    missing = kpis.missing_dates(raw, date(2024, 3, 1), date(2024, 3, 4))
    assert sorted(r.event_date for r in missing.collect()) == ["2024-03-02", "2024-03-04"]
    got = {r.event_date: r.difference for r in kpis.reconcile_counts(raw, curated).collect()}
    assert got == {"2024-03-01": 1, "2024-03-03": 1, "2024-03-04": -1}


def test_average_risk_of_an_hour_without_logins(spark):
    df = spark.createDataFrame(
        [(T0, 0, 0), (T0 + timedelta(hours=1), 4, 10)],
        "window_start timestamp, total_logins long, total_risk_score long",
    )
    got = kpis.average_risk_per_hour(df, T0 + timedelta(hours=2)).collect()
    assert [r.avg_risk_score for r in got] == [None, 2.5]


def test_empty_inputs(spark):
    none = frame(spark, [])
    assert kpis.host_coverage(none).count() == 0
    assert analytics.unique_actors(none).first().rows_loaded == 0
    assert kpis.low_volume_alarm(none, 5).count() == 0


def test_freshness_status_bounds(spark):
    curated = frame(spark, [event(0)]).withColumn("event_date", F.lit("2024-03-01"))
    for lag, status in ((300, "OK"), (301, "SLA_BREACH")):
        got = analytics.data_freshness(curated, T0 + timedelta(seconds=lag)).first()
        assert (got.lag_seconds, got.freshness_status) == (lag, status)


def test_flags_count_per_event_and_flag(spark):
    rows = [("U1", 45, ["a", "b"], "2024-03-01"), ("U1", 10, ["b"], "2024-03-01"), ("U2", 0, [], "2024-03-01")]
    df = spark.createDataFrame(rows, "user_id string, risk_score int, risk_flags array<string>, event_date string")
    got = analytics.high_risk_users(df, T0).collect()
    assert [tuple(r) for r in got] == [("U1", 3, 45, 100, ["a", "b"])]
