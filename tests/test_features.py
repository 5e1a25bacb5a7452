from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gatewatch.config import DAY_HOP, HOUR_HOP, HopSpec
from gatewatch.operators.dedup import deduplicate
from gatewatch.operators.enrich import attach_features, attach_window_features, behavior_context
from gatewatch.operators.features import compute_rolling_windows, features_at_events, window_features
from gatewatch.operators.firstseen import flag_new_devices, merge_seen_pairs, new_pairs, seen_pairs
from gatewatch.operators.rolling import rolling_activity
from gatewatch.operators.rollups import flag_rare_hosts, rare_hosts_daily, user_behavior_hourly
from gatewatch.operators.timeline import running_totals, with_neighbours
from helpers import START, as_windows, event, first_seen, frame, skewed_events, windows


@pytest.fixture(scope="module")
def rows():
    return skewed_events()


@pytest.fixture(scope="module")
def events(spark, rows):
    return frame(spark, rows).repartition(4).cache()


@pytest.mark.parametrize(
    "hop",
    [HOUR_HOP, DAY_HOP, HopSpec("x", 1800, 600), HopSpec("x", 3600, 3600)],
    ids=["1h", "24h", "30m", "tumbling"],
)
def test_windows_equal_copied_windows(events, rows, hop):
    assert as_windows(window_features(events, [hop])) == windows(rows, hop.duration, hop.slide)


def test_windows_that_are_no_multiple_of_their_slide(events, rows):
    hop = HopSpec("x", 4000, 1500)
    with pytest.raises(ValueError):
        window_features(events, [hop])
    assert as_windows(window_features(flag_new_devices(events), [hop])) == windows(rows, 4000, 1500)


def test_both_window_lengths_in_one_table(events, rows):
    both = compute_rolling_windows(events)
    assert as_windows(both.filter("window_size = '1h'")) == windows(rows, 3600, 300)
    assert as_windows(both.filter("window_size = '24h'")) == windows(rows, 86400, 3600)
    tumbling = compute_rolling_windows(events, use_hop_windows=False)
    assert as_windows(tumbling.filter("window_size = '24h'")) == windows(rows, 86400, 86400)


def test_windows_are_dealt_by_day_before_they_are_written_out(events):
    whole = window_features(events, [HOUR_HOP, DAY_HOP])
    dealt = window_features(events, [HOUR_HOP, DAY_HOP], by_day=True)
    assert as_windows(dealt.filter("window_size = '1h'")) == as_windows(whole.filter("window_size = '1h'"))
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate explode(sequence(slot") < plan.index("RebalancePartitions")


def test_flags_given_with_the_events_are_used(events, rows):
    none_new = window_features(events.withColumn("is_new_device", F.lit(False)), [HOUR_HOP])
    assert not any(flag for _, _, flag in as_windows(none_new).values())


def test_features_at_events_equal_range_join(events, rows):
    hour, day = windows(rows, 3600, 300), windows(rows, 86400, 3600)
    got = {
        r.event_id: (r.window_1h_event_count, r.window_1h_unique_hosts, r.window_24h_unique_hosts, r.has_new_device)
        for r in attach_features(events).collect()
    }
    for time, user, _, _, _, name in rows:
        second = time.timestamp()
        first_1h = min(s for s, u in hour if u == user and s <= second < s + 3600)
        first_24h = min(s for s, u in day if u == user and s <= second < s + 86400)
        hosts, count, new = hour[(first_1h, user)]
        assert got[name] == (count, hosts, day[(first_24h, user)][0], new)


def test_feature_table_join_equals_direct_form(events):
    direct = attach_features(events).select("event_id", "window_1h_event_count", "window_24h_unique_hosts")
    table = window_features(events, [HOUR_HOP, DAY_HOP])
    joined = attach_window_features(attach_window_features(events, table, HOUR_HOP), table, DAY_HOP)
    assert joined.select(*direct.columns).exceptAll(direct).isEmpty()
    absent = attach_window_features(events, table.limit(0), HOUR_HOP).first()
    assert (absent.window_1h_event_count, absent.window_1h_has_new_device) == (0, False)


def test_event_on_a_window_end_belongs_to_the_next(spark):
    rows = [event(0), event(300), event(3600), event(3899.999)]
    got = {r.event_id: r.window_1h_event_count for r in attach_features(frame(spark, rows)).collect()}
    assert got == {"0-U1-C1": 1, "300-U1-C1": 2, "3600-U1-C1": 3, "3899.999-U1-C1": 3}


def test_events_before_the_epoch(spark):
    old = [(START - timedelta(days=30000, seconds=s), "U1", None, "C1", True, f"e{s}") for s in (0, 400, 4000)]
    assert as_windows(window_features(frame(spark, old), [HOUR_HOP])) == windows(old, 3600, 300)


def test_slides_must_nest(events):
    with pytest.raises(ValueError):
        features_at_events(events, HOUR_HOP, HopSpec("24h", 86400, 400))


def test_first_seen(events, rows):
    flagged = flag_new_devices(events)
    assert {r.event_id for r in flagged.filter("is_new_device").collect()} == first_seen(rows)
    assert flagged.count() == len(rows)


def test_first_seen_with_history(spark, events, rows):
    middle = START + timedelta(days=2)
    early = events.filter(F.col("event_time") < F.lit(middle))
    late = events.filter(F.col("event_time") >= F.lit(middle))
    history = seen_pairs(early)
    got = {r.event_id for r in flag_new_devices(late, history).filter("is_new_device").collect()}
    assert got == {r[5] for r in rows if r[0] >= middle} & first_seen(rows)
    windowed = window_features(late, [HOUR_HOP], history)
    with_flags = window_features(flag_new_devices(late, history), [HOUR_HOP])
    assert windowed.exceptAll(with_flags).isEmpty() and with_flags.exceptAll(windowed).isEmpty()
    assert new_pairs(late, history).count() == len(got)
    merged = merge_seen_pairs(history, seen_pairs(late))
    whole = seen_pairs(events)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_first_seen_with_ttl(spark):
    rows = [event(0), event(50), event(86400 * 2), event(86400 * 2 + 10), event(86400 * 2, event_id="a-tie")]
    flagged = flag_new_devices(frame(spark, rows), ttl="1 day").filter("is_new_device")
    assert {r.event_id for r in flagged.collect()} == {"0-U1-C1", "172800-U1-C1"}


def test_deduplicate_keeps_the_earliest(spark):
    rows = [event(5, event_id="a"), event(1, event_id="a", host="C2"), event(2, event_id="b")]
    got = {(r.event_id, r.computer_id) for r in deduplicate(frame(spark, rows)).collect()}
    assert got == {("a", "C2"), ("b", "C1")}


def test_one_id_on_a_third_of_all_rows_is_cut_before_the_shuffle(spark):
    copies = frame(spark, [event(n, event_id="same") for n in range(200)] + skewed_events(100))
    plan = deduplicate(copies.repartition(4))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert deduplicate(copies).count() == 101


def test_rolling_activity(events, rows):
    got = {r.event_id: r for r in rolling_activity(events).collect()}
    assert len(got) == len(rows)
    for time, user, _, _, _, name in rows:
        for label, hours in (("1h", 1), ("24h", 24)):
            past = [r for r in rows if r[1] == user and time - timedelta(hours=hours) <= r[0] <= time]
            assert got[name][f"login_count_{label}"] == len(past)
            assert got[name][f"unique_computers_{label}"] == len({r[3] for r in past})


def test_rolling_activity_holds_no_table_of_events(events):
    """Two sorts of one layout: hash tables and joins took ten times the memory of a task."""
    plan = rolling_activity(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan and "Join" not in plan


def test_rolling_activity_of_equal_times_and_chunk_ends(spark):
    """Rows of equal time count one another; a span reaches back over the end of a day, both ends included."""
    day = 86400
    rows = [event(day - 3600, event_id="a"), event(day - 3600, host="C2", event_id="b"), event(day - 3600, event_id="c")]
    rows += [event(day, event_id="d"), event(day + 1, host="C3", event_id="e"), event(2 * day, host="C3", event_id="f")]
    events = frame(spark, rows).union(frame(spark, [event(5, event_id="g")]).withColumn("user_id", F.lit(None).cast("string")))
    counts = ["login_count_1h", "unique_computers_1h", "login_count_24h", "unique_computers_24h"]
    got = {r.event_id: tuple(r[c] for c in counts) for r in rolling_activity(events).collect()}
    assert got == {
        "a": (3, 2, 3, 2), "b": (3, 2, 3, 2), "c": (3, 2, 3, 2), "d": (4, 2, 4, 2), "e": (2, 2, 5, 3), "f": (1, 1, 3, 2),
        "g": (None, None, None, None),
    }


def test_timeline_chunks_change_nothing(spark):
    data = [("k", p, 1) for p in (-25, -3, 0, 4, 9, 10, 11, 39, 40, 41, 99)] + [("j", 5, 2)]
    points = spark.createDataFrame(data, "key string, pos long, v long")
    whole = with_neighbours(points, ["key"], "pos")
    cut = with_neighbours(points, ["key"], "pos", chunk=10).select(*whole.columns)
    assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()
    totals = running_totals(points, ["key"], "pos", ["v"]).drop("next")
    cut_totals = running_totals(points, ["key"], "pos", ["v"], chunk=10).select(*totals.columns)
    assert totals.exceptAll(cut_totals).isEmpty() and cut_totals.exceptAll(totals).isEmpty()


def test_rare_hosts_by_rank(spark):
    rows = []
    for host in range(41):
        for user in range(1 if host < 3 else 2 + host % 4):
            rows.append(event(host * 60 + user, f"U{user}", f"C{host:02d}", f"{host}-{user}"))
    rows.append(event(86400, "U1", "C_only", "next-day"))
    rare = {(r.event_date, r.computer_id) for r in rare_hosts_daily(frame(spark, rows)).collect()}
    # All three least visited hosts share rank 0; the day with one host has only rank 0.
    assert rare == {("2024-03-01", f"C{h:02d}") for h in range(3)} | {("2024-03-02", "C_only")}
    flagged = flag_rare_hosts(frame(spark, rows))
    assert flagged.filter("is_rare_host").count() == 4 and flagged.count() == len(rows)


def test_hourly_rollup_reads_null_flags_as_false(spark):
    columns = "event_time timestamp, user_id string, dst_host string, has_new_device boolean"
    stamp = START.astimezone(timezone.utc)
    df = spark.createDataFrame([(stamp, "U1", "C1", None), (stamp + timedelta(minutes=59), "U1", "C1", None)], columns)
    row = user_behavior_hourly(df).first()
    assert (row.event_count, row.unique_hosts, row.has_new_device) == (2, 1, False)


def test_behavior_context_equals_full_join(spark, events):
    scored = events.select(
        "event_time",
        "user_id",
        F.col("computer_id").alias("dst_host"),
        (F.hash("event_id") % 5).alias("risk_score"),
        F.array().cast("array<string>").alias("risk_flags"),
    )
    table = window_features(events.filter("user_id <> 'U3'"), [HOUR_HOP])
    got = behavior_context(scored, table, limit=30)
    side = table.select("user_id", "window_start", "unique_hosts", "event_count", "has_new_device")
    full = (
        scored.join(side, "user_id", "left")
        .orderBy(
            F.desc("risk_score"), F.desc("event_time"), "user_id", "dst_host", F.asc_nulls_first("window_start")
        )
        .limit(30)
    )
    keys = ["user_id", "event_time", "dst_host", "window_start"]
    assert [tuple(r) for r in got.select(keys).collect()] == [tuple(r) for r in full.select(keys).collect()]


def test_first_seen_with_ttl_and_history(spark):
    """A pair counts as known for as long as the history's last sighting is not too old."""
    day = 86400
    history = seen_pairs(frame(spark, [event(0), event(day * 9), event(0, "U2", "C2")]))
    rows = [event(day * 10), event(day * 20), event(day * 10, "U2", "C2"), event(day * 21, "U3", "C3")]
    flagged = flag_new_devices(frame(spark, rows), history, ttl="3 days").filter("is_new_device")
    assert {r.event_id for r in flagged.collect()} == {f"{day * 20}-U1-C1", f"{day * 10}-U2-C2", f"{day * 21}-U3-C3"}
