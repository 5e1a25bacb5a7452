"""The registered queries: each reads the given tables whole and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, TimestampType

from gatewatch import schemas
from gatewatch.config import DAY_HOP, HOUR_HOP, PipelineConfig, RiskConfig, StreamConfig, TablePaths
from gatewatch.functions import risk
from gatewatch.functions.times import as_of_column, event_date
from gatewatch.operators import rollups
from gatewatch.operators.dedup import deduplicate
from gatewatch.operators.enrich import attach_features, attach_window_features
from gatewatch.operators.features import compute_rolling_windows, window_features
from gatewatch.operators.firstseen import flag_new_devices, merge_seen_pairs, new_pairs, seen_pairs
from gatewatch.operators.rolling import rolling_activity
from gatewatch.plans import analytics, changes, jobs, kpis, quality
from gatewatch.plans.curated import build_curated, build_features, build_raw, build_wide, clean_events
from gatewatch.session import prepare, scratch_path
from gatewatch.sources import payload, tables, validate
from gatewatch.sources.activity import auth_events, between
from gatewatch.sources.logs import parse_lines
from gatewatch.streaming import alarms, pipeline, replay, rolling, tail
from gatewatch.streaming.sources import read_payloads, validated_stream

# The test data never reaches the default thresholds, so these are lower.
SCALED = PipelineConfig(
    risk=RiskConfig(
        lateral_movement_unique_hosts_1h=2,
        burst_login_event_count_1h=2,
        new_device_spike_unique_hosts_24h=4,
    )
)
BACKFILL = (date(2024, 1, 10), date(2024, 1, 20))


def comparable(df: DataFrame) -> DataFrame:
    """Zone-free times, joined arrays and rounded fractions, so values compare exactly."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(field.dataType, (DoubleType, FloatType)):
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Inputs:
    """The tables of one scale factor and what the queries derive from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    @property
    def activity(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet")

    @property
    def events(self) -> DataFrame:
        return auth_events(self.activity)

    @property
    def clean(self) -> DataFrame:
        return clean_events(self.events)

    @property
    def features(self) -> DataFrame:
        return build_features(self.events, SCALED)

    def hop(self, spec) -> DataFrame:
        return window_features(self.clean, [spec])

    @property
    def curated(self) -> DataFrame:
        return build_curated(self.events, SCALED)

    @property
    def curated_with_id(self) -> DataFrame:
        return build_curated(self.events, SCALED, keep_event_id=True)

    @property
    def wide(self) -> DataFrame:
        return build_wide(self.events, SCALED)

    @property
    def lagged(self) -> DataFrame:
        """Events with a processing time that lags by their value in seconds."""
        time = F.col("ts").cast("timestamp")
        lag = F.floor("value").cast("long") * 1_000_000
        return self.activity.select(
            time.alias("event_time"), F.timestamp_micros(F.unix_micros(time) + lag).alias("processing_time")
        )

    def _seconds(self):
        return F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")

    @property
    def lines(self) -> DataFrame:
        """Every event as a log line."""
        e = self.events.select(F.unix_seconds("event_time").cast("string").alias("t"), "user_id", "computer_id")
        return e.select(F.concat_ws(",", "t", "user_id", "computer_id").alias("value"))

    @property
    def faulty_lines(self) -> DataFrame:
        """Log lines with a fault that depends on the type of the event."""
        kind, host = F.col("event_type"), F.get_json_object("props", "$.k")
        fields = F.concat_ws(
            ",",
            F.when(kind == "view", F.concat(F.lit("t"), self._seconds())).otherwise(self._seconds()),
            F.when(kind == "error", " ").otherwise(F.concat(F.lit("U"), F.col("user_id"))),
            F.concat(F.lit("C"), host),
            F.when(kind == "signup", "extra"),
        )
        return self.activity.select(fields.alias("value"))

    @property
    def faulty_payloads(self) -> DataFrame:
        """JSON payloads with a fault that depends on the type of the event."""
        kind, host = F.col("event_type"), F.get_json_object("props", "$.k")
        iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        body = F.to_json(
            F.struct(
                F.when(kind == "view", iso).otherwise(F.concat(iso, F.lit("Z"))).alias("event_time"),
                F.concat(F.lit("U"), F.col("user_id")).alias("user_id"),
                F.when(kind == "error", "").otherwise(F.concat(F.lit("C"), host)).alias("computer_id"),
                F.col("event_id").cast("string").alias("event_id"),
                F.when(kind == "purchase", "1").alias("surplus"),
            )
        )
        return self.activity.select(
            F.col("ts").cast("timestamp").alias("ts"),
            F.when(kind == "signup", F.concat(F.lit("{"), body)).otherwise(body).alias("value"),
        )

    @property
    def checked(self) -> DataFrame:
        """Events whose host is blanked for errors and whose time is missing for views."""
        kind = F.col("event_type")
        e = self.activity.select(
            F.col("ts").cast("timestamp").alias("ts"),
            F.when(kind != "view", F.col("ts").cast("timestamp")).alias("event_time"),
            F.concat(F.lit("U"), F.col("user_id")).alias("user_id"),
            F.when(kind == "error", " ").otherwise(F.concat(F.lit("C"), F.get_json_object("props", "$.k"))).alias(
                "computer_id"
            ),
            F.col("event_id").cast("string").alias("event_id"),
        )
        return validate.validate_events(e)

    @property
    def spoiled(self) -> DataFrame:
        """Curated events with nulls and scores out of range."""
        return self.curated.select(
            F.when(F.col("dst_host") != "C1", F.col("user_id")).alias("user_id"),
            "event_time",
            F.when(F.col("success"), F.col("risk_score") + 50).otherwise(F.col("risk_score")).alias("risk_score"),
            F.when(F.col("has_new_device"), F.col("success")).alias("success"),
        )

    @property
    def midnight(self):
        return F.date_trunc("day", as_of_column(self.events)) + F.expr("INTERVAL 1 DAY")

    # Streams

    def stream(self) -> DataFrame:
        pipeline.prepare_streaming(self.spark)
        # A stream reads folders; the pattern lets the table be one file as well.
        files = self.spark.readStream.schema(self.activity.schema).parquet(f"{self.sf_dir}/events.parque[t]")
        return auth_events(files)

    @property
    def once(self) -> StreamConfig:
        """Read all there is. State is split by cores unless the session says how."""
        unset = self.spark.conf.get("spark.sql.shuffle.partitions") == "200"
        cores = self.spark.sparkContext.defaultParallelism
        return StreamConfig(trigger_once=True, state_partitions=cores if unset else None)

    def drained(self, stream: DataFrame, label: str) -> DataFrame:
        """Run a stream over all there is, into a table in the shared folder."""
        path = scratch_path(self.spark, label)
        query = pipeline.start_sink(stream, f"{path}/table", [], f"{path}/checkpoint", self.once)
        query.awaitTermination()
        return self.spark.read.schema(stream.schema).parquet(f"{path}/table")

    def flagged_stream(self, **options) -> DataFrame:
        return pipeline.flagged_stream(self.stream(), StreamConfig(**options))

    def backfilled(self) -> TablePaths:
        """Raw table of all events, then ten days rebuilt from it, twice."""
        paths = TablePaths(scratch_path(self.spark, "backfill"))
        jobs.ingest(self.events, paths)
        for _ in range(2):
            jobs.backfill(self.spark, paths, *BACKFILL, cfg=SCALED)
        return paths


    def changed(self) -> TablePaths:
        """All tables built from a part of the events, then brought up to date with the rest.

        The rest holds events of all days, among them first ones of pairs that the part has
        later, so days are built again that no new file belongs to.
        """
        paths = TablePaths(scratch_path(self.spark, "changed"))
        part = F.dayofmonth("event_time") % 2 == 0
        jobs.ingest(self.events.filter(part), paths)
        changes.refresh_changed(self.spark, paths, SCALED)
        jobs.ingest(self.events.filter(~part), paths)
        changes.refresh_changed(self.spark, paths, SCALED)
        return paths

    def wide_days(self) -> TablePaths:
        """Ten wide days and the rollups of them, built twice from the raw table."""
        paths = TablePaths(scratch_path(self.spark, "wide"))
        jobs.ingest(self.events, paths)
        for _ in range(2):
            jobs.backfill_wide(self.spark, paths, *BACKFILL, cfg=SCALED)
        return paths

    def feature_days(self) -> TablePaths:
        paths = TablePaths(scratch_path(self.spark, "features"))
        jobs.ingest(self.events, paths)
        for _ in range(2):
            jobs.backfill_features(self.spark, paths, *BACKFILL, cfg=SCALED)
        return paths


def _scan_lines(i: Inputs) -> DataFrame:
    return parse_lines(i.lines).select("event_time", "user_id", "computer_id", "event_id", "success")


def _dedup(i: Inputs) -> DataFrame:
    later = i.events.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 SECOND"))
    return deduplicate(i.events.unionByName(later)).select("event_id", "event_time", "user_id", "computer_id")


def _roundtrip(i: Inputs) -> DataFrame:
    sent = payload.encode_payload(i.events).withColumn("value", F.col("value").cast("binary"))
    received = validate.valid_events(payload.decode_payload(sent, strict=True))
    return received.select("event_time", "user_id", "computer_id", "event_id")


def _rejects(i: Inputs) -> DataFrame:
    decoded = payload.decode_payload(i.faulty_payloads, strict=True)
    return validate.dead_letters(decoded).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


def _new_pairs(i: Inputs) -> DataFrame:
    return new_pairs(i.events.filter("success"), i.events.filter("NOT success"))


def _merged(i: Inputs) -> DataFrame:
    return merge_seen_pairs(seen_pairs(i.events.filter("success")), seen_pairs(i.events.filter("NOT success")))


def _near(i: Inputs, hop) -> DataFrame:
    return attach_window_features(i.clean, i.hop(hop), hop)


def _sql_functions(i: Inputs) -> DataFrame:
    risk.register_risk_functions(i.spark, SCALED.risk)
    args = (
        "user_id, dst_host, src_host, event_time, window_1h_event_count, window_1h_unique_hosts, "
        "window_24h_unique_hosts, has_new_device"
    )
    scored = i.curated_with_id.drop("risk_score", "risk_flags")
    return scored.selectExpr("event_id", f"risk_score({args}) AS risk_score", f"risk_flags({args}) AS risk_flags")


def _predicates(i: Inputs) -> DataFrame:
    return i.curated_with_id.select(
        "event_id",
        risk.detect_lateral_movement("window_1h_unique_hosts", 2).alias("lateral"),
        risk.detect_burst_login("window_1h_event_count", 2).alias("burst"),
        risk.detect_new_device("has_new_device").alias("new_device"),
        risk.detect_rare_host("has_new_device").alias("rare_host"),
        risk.detect_new_device_spike("has_new_device", "window_24h_unique_hosts", 4).alias("spike"),
    )


def _basic_risk(i: Inputs) -> DataFrame:
    score, flags = risk.evaluate_basic_risk("is_new_device", ~F.col("success"))
    return flag_new_devices(i.clean).select("event_id", score.alias("risk_score"), flags.alias("flags"))


def _last_hour(i: Inputs) -> DataFrame:
    users = analytics.high_risk_users_last_hour(i.curated, i.events)
    lists = F.array_sort(F.transform("flags", lambda f: F.concat(F.lit("["), F.array_join(f, ","), F.lit("]"))))
    return users.withColumn("flags", F.array_join(lists, ";"))


def _with_behavior(i: Inputs) -> DataFrame:
    return analytics.high_risk_with_behavior(i.curated, i.hop(HOUR_HOP), i.events)


def _average_risk(i: Inputs) -> DataFrame:
    return kpis.average_risk_per_hour(rollups.user_risk_hourly(i.wide), i.events)


def _missing(i: Inputs) -> DataFrame:
    last = F.date_add(F.to_date(as_of_column(i.events)), 5)
    return kpis.missing_dates(build_raw(i.events), date(2023, 12, 25), last)


def _invalid_rate(i: Inputs) -> DataFrame:
    return validate.invalid_rate(i.checked, F.date_trunc("hour", "ts"), "hour")


def _violations(i: Inputs) -> DataFrame:
    return kpis.sla_checks(
        build_raw(i.events),
        i.curated.filter("success"),
        i.lagged,
        _invalid_rate(i),
        date(2023, 12, 25),
        date(2024, 1, 5),
    )


def _reconcile(i: Inputs) -> DataFrame:
    return kpis.reconcile_counts(build_raw(i.events), i.curated.filter("success"))


def _dq_spoiled(i: Inputs) -> DataFrame:
    return quality.run_suite(i.spoiled)


def _dq_files(i: Inputs) -> DataFrame:
    """The curated suite over a stored table that lacks two columns the scan declares."""
    path = TablePaths(scratch_path(i.spark, "narrow"))
    i.curated.drop("src_host", "risk_flags").write.partitionBy("event_date").parquet(path.curated)
    stored = tables.files_schema(i.spark, path.curated, schemas.CURATED)
    return quality.run_suite(tables.curated_events(i.spark, path), stored=stored)


def _replayed(i: Inputs) -> DataFrame:
    """All events staged, published step by step over a restart, and read back as a stream."""
    path = scratch_path(i.spark, "replay")
    size = -(-i.events.count() // 12)
    steps = replay.stage_replay(i.clean, f"{path}/staged", size)
    for until in (steps // 2, steps):
        query = replay.start_replay(i.spark, f"{path}/staged", f"{path}/in", f"{path}/replay", steps, trigger_seconds=0.1)
        replay.await_replay(i.spark, query, f"{path}/in", until)
    cfg = StreamConfig(source_format="text", source_path=f"{path}/in", max_files_per_trigger=1, trigger_once=True)
    pipeline.prepare_streaming(i.spark)
    events = validate.valid_events(validated_stream(read_payloads(i.spark, cfg)))
    return i.drained(events.withWatermark("event_time", "1 second"), "replayed").select("event_id", "event_time", "user_id", "computer_id")


def _stored_stream(i: Inputs, label: str) -> PipelineConfig:
    """First stage of the pipeline: flag the events and store them as the raw table."""
    paths = TablePaths(scratch_path(i.spark, label))
    cfg = PipelineConfig(risk=SCALED.risk, tables=paths, stream=i.once)
    flagged = i.flagged_stream().withColumn("event_date", event_date())
    pipeline.start_sink(flagged, paths.raw, ["event_date"], paths.path("checkpoint/raw"), cfg.stream).awaitTermination()
    return cfg


def _features_stream(i: Inputs) -> DataFrame:
    cfg = _stored_stream(i, "stream-features")
    pipeline.start_features(i.spark, cfg).awaitTermination()
    return tail.complete_features(i.spark, cfg)


def _curated_stream(i: Inputs) -> DataFrame:
    cfg = _stored_stream(i, "stream-curated")
    pipeline.start_curated(i.spark, cfg).awaitTermination()
    return tail.complete_curated(i.spark, cfg)


def _ingested_twice(i: Inputs) -> DataFrame:
    """All events, then all again with some of later days and some without id."""
    paths = TablePaths(scratch_path(i.spark, "ingest"))
    jobs.ingest(i.events, paths)
    jobs.ingest(i.events.unionByName(i.events.filter("NOT success")), paths)
    return tables.raw_events(i.spark, paths).select("event_id", "event_time", "user_id", "computer_id")


def _without_ids(i: Inputs) -> DataFrame:
    nameless = i.events.withColumn("event_id", F.when(F.col("success"), F.col("event_id")))
    return clean_events(nameless.unionByName(nameless)).groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))


PLANS: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources, parsing, validation
    "log_scan": _scan_lines,
    "log_scan_joined_ids": lambda i: parse_lines(i.lines, event_id="joined").select("event_time", "event_id"),
    "log_scan_base_epoch": lambda i: parse_lines(i.lines, base_epoch=1_704_067_200).select("event_time", "user_id"),
    "log_reject_counts": lambda i: validate.reject_counts(parse_lines(i.faulty_lines)),
    "payload_encode": lambda i: payload.encode_payload(i.events),
    "payload_roundtrip": _roundtrip,
    "payload_rejects": _rejects,
    "invalid_rate_per_hour": _invalid_rate,
    "ingest_summary": lambda i: payload.ingest_summary(i.checked),
    "canonical_events": lambda i: i.clean.select("event_time", "user_id", "computer_id", "event_id"),
    "scoring_view": lambda i: validate.scoring_view(i.clean),
    "raw_table": lambda i: build_raw(i.events),
    "time_range_scan": lambda i: auth_events(between(i.activity, date(2024, 1, 10), date(2024, 1, 12))).select(
        "event_time", "user_id"
    ),
    # deduplication and first-seen state
    "dedup_events": _dedup,
    "first_seen_flags": lambda i: flag_new_devices(i.clean).select(
        "event_id", "user_id", "computer_id", "is_new_device"
    ),
    "first_seen_ttl": lambda i: flag_new_devices(i.clean, ttl="3 days").select("event_id", "is_new_device"),
    "seen_pairs": lambda i: seen_pairs(i.events),
    "new_pairs": _new_pairs,
    "merged_history": _merged,
    # windows and rollups
    "features_1h": lambda i: i.hop(HOUR_HOP),
    "features_24h": lambda i: i.hop(DAY_HOP),
    "features_all": lambda i: i.features,
    "features_tumbling": lambda i: compute_rolling_windows(i.clean, use_hop_windows=False),
    "user_behavior_hourly": lambda i: rollups.user_behavior_hourly(i.curated),
    "user_risk_hourly": lambda i: rollups.user_risk_hourly(i.wide),
    "host_access_daily": lambda i: rollups.host_access_daily(i.clean),
    "host_popularity_daily": lambda i: rollups.host_popularity_daily(i.curated),
    "host_risk_daily": lambda i: rollups.host_risk_daily(i.wide),
    "rolling_activity": lambda i: rolling_activity(i.clean).select(
        "event_id", "login_count_1h", "unique_computers_1h", "login_count_24h", "unique_computers_24h"
    ),
    "rare_hosts_daily": lambda i: rollups.rare_hosts_daily(i.clean),
    # joins with features
    "event_features_1h": lambda i: _near(i, HOUR_HOP).select(
        "event_id", "window_1h_event_count", "window_1h_unique_hosts", "window_1h_has_new_device"
    ),
    "event_features_24h": lambda i: _near(i, DAY_HOP).select("event_id", "window_24h_unique_hosts"),
    "event_features_both": lambda i: attach_features(i.clean).select(
        "event_id", "window_1h_event_count", "window_1h_unique_hosts", "window_24h_unique_hosts", "has_new_device"
    ),
    "exploded_flags": lambda i: i.curated_with_id.select(
        "event_id", "risk_score", F.explode("risk_flags").alias("risk_flag")
    ),
    # scoring
    "curated_events": lambda i: i.curated,
    "curated_default_rules": lambda i: build_curated(i.events),
    "curated_popularity_rule": lambda i: build_curated(
        i.events, PipelineConfig(risk=RiskConfig.of({**SCALED.risk.as_dict(), "rare_host_mode": "popularity"}))
    ),
    "risk_sql_functions": _sql_functions,
    "risk_predicates": _predicates,
    "basic_risk": _basic_risk,
    "risk_levels": lambda i: i.curated_with_id.select(
        "event_id", "risk_score", risk.risk_level().alias("risk_level")
    ),
    "wide_events": lambda i: i.wide.drop("src_host"),
    # reports
    "high_risk_users": lambda i: analytics.high_risk_users(i.curated, i.events),
    "risky_hosts": lambda i: analytics.risky_hosts(i.curated, i.events),
    "events_per_minute": lambda i: analytics.events_per_minute(i.curated, i.events),
    "unique_users_per_hour": lambda i: analytics.unique_users_per_hour(i.curated, i.events),
    "lateral_movement_windows": lambda i: analytics.lateral_movement_windows(i.hop(HOUR_HOP), i.events, min_hosts=2),
    "new_device_alerts": lambda i: analytics.new_device_alerts(i.curated, i.events),
    "data_freshness": lambda i: analytics.data_freshness(i.curated, i.midnight),
    "latest_events": lambda i: analytics.latest_events(i.curated),
    "high_risk_events": lambda i: analytics.high_risk_events(i.curated, i.events),
    "users_by_average_risk": lambda i: analytics.users_by_average_risk(i.curated),
    "events_by_triage_level": lambda i: analytics.events_by_triage_level(i.curated),
    "latest_hourly_windows": lambda i: analytics.latest_hourly_windows(i.hop(HOUR_HOP)),
    "widest_daily_windows": lambda i: analytics.widest_daily_windows(i.hop(DAY_HOP)),
    "top_hosts_of_day": lambda i: analytics.top_hosts_of_day(
        rollups.host_popularity_daily(i.curated), F.to_date(as_of_column(i.events))
    ),
    "high_risk_with_behavior": _with_behavior,
    "high_risk_users_last_hour": _last_hour,
    "volume_per_day": lambda i: analytics.volume_per_day(i.events),
    "unique_actors": lambda i: analytics.unique_actors(i.events),
    "unique_actors_per_day": lambda i: analytics.unique_actors_per_day(i.events),
    "risk_flag_distribution": lambda i: analytics.risk_flag_distribution(i.curated),
    "risk_level_distribution": lambda i: analytics.risk_level_distribution(i.curated),
    "logins_by_hour_of_day": lambda i: analytics.logins_by_hour_of_day(i.events),
    "host_access_distribution": lambda i: analytics.host_access_distribution(i.events),
    "new_devices_per_day": lambda i: analytics.new_devices_per_day(flag_new_devices(i.clean)),
    # key figures and service levels
    "kpi_freshness": lambda i: kpis.freshness(i.lagged),
    "kpi_missing_dates": _missing,
    "kpi_reconcile_counts": _reconcile,
    "kpi_sla_violations": _violations,
    "kpi_throughput": lambda i: kpis.throughput_per_minute(i.events),
    "kpi_high_risk_rate": lambda i: kpis.high_risk_rate(i.wide, i.events),
    "kpi_new_device_rate": lambda i: kpis.new_device_rate(i.wide, i.events),
    "kpi_lateral_users_per_hour": lambda i: kpis.lateral_users_per_hour(i.wide, i.events),
    "kpi_burst_logins": lambda i: kpis.burst_login_incidents(i.wide),
    "kpi_average_risk_per_hour": _average_risk,
    "kpi_rare_host_events": lambda i: kpis.rare_host_events_per_day(i.wide),
    "kpi_active_users_per_hour": lambda i: kpis.active_users_per_hour(rollups.user_behavior_hourly(i.curated)),
    "kpi_active_users_per_day": lambda i: kpis.active_users_per_day(i.events),
    "kpi_host_coverage": lambda i: kpis.host_coverage(i.events),
    "kpi_high_risk_hours": lambda i: kpis.high_risk_hours(i.wide, limit=2),
    "kpi_low_volume_alarm": lambda i: kpis.low_volume_alarm(i.events, threshold=2),
    "kpi_lag_alarm": lambda i: kpis.alarm_minutes(kpis.minute_lag(i.lagged), F.col("value") >= 20, 2, 3),
    # data quality
    "dq_curated": lambda i: quality.run_suite(i.curated).drop("details"),
    "dq_spoiled": lambda i: _dq_spoiled(i).drop("details"),
    "dq_schema_of_files": lambda i: _dq_files(i).drop("details"),
    "dq_invalid_stats": lambda i: quality.invalid_record_stats(_dq_spoiled(i)),
    "dq_overall": lambda i: quality.overall_status(quality.run_suite(i.curated)),
    # jobs
    "job_backfill_curated": lambda i: tables.curated_events(i.spark, i.backfilled()),
    "job_backfill_hourly": lambda i: tables.user_behavior_hourly(i.spark, i.backfilled()),
    "job_ingest_twice": _ingested_twice,
    "events_without_ids": _without_ids,
    "job_backfill_hosts": lambda i: tables.host_popularity_daily(i.spark, i.backfilled()),
    "job_backfill_wide": lambda i: tables.wide_events(i.spark, i.wide_days()).drop("src_host"),
    "job_backfill_host_risk": lambda i: tables.host_risk_daily(i.spark, i.wide_days()),
    "job_backfill_user_risk": lambda i: tables.user_risk_hourly(i.spark, i.wide_days()),
    "job_backfill_features": lambda i: tables.stored_features(i.spark, i.feature_days()),
    "job_refresh_changed": lambda i: tables.wide_events(i.spark, i.changed()).drop("src_host"),
    "job_refresh_changed_features": lambda i: tables.features(i.spark, i.changed()),
    # streams
    "stream_dedup": lambda i: i.drained(pipeline.unique_stream(i.stream(), "5 minutes"), "stream-dedup").select(
        "event_id", "event_time", "user_id", "computer_id"
    ),
    "stream_first_seen": lambda i: i.drained(i.flagged_stream(), "stream-first-seen").select(
        "event_id", "user_id", "computer_id", "is_new_device"
    ),
    "stream_first_seen_ttl": lambda i: i.drained(i.flagged_stream(state_ttl="3 days"), "stream-ttl").select(
        "event_id", "is_new_device"
    ),
    "stream_rolling_activity": lambda i: i.drained(
        rolling.rolling_stream(pipeline.unique_stream(i.stream(), "5 minutes")), "stream-rolling"
    ).select("event_id", "login_count_1h", "unique_computers_1h", "login_count_24h", "unique_computers_24h"),
    "stream_low_volume_alarm": lambda i: i.drained(
        alarms.low_volume_stream(pipeline.unique_stream(i.stream(), "5 minutes"), threshold=2), "stream-alarm"
    ).drop("series"),
    "replay_in_steps": _replayed,
    "stream_features": _features_stream,
    "stream_curated": _curated_stream,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(plan):
        return lambda spark, sf_dir: comparable(plan(Inputs(spark, sf_dir)))

    return {name: bound(plan) for name, plan in PLANS.items()}
