"""The streaming pipeline: queries with their own checkpoints, handing on by stored tables.

The source is read once. Each micro-batch of it is decoded once and split into valid events,
which land in a folder between, and dead letters. Deduplication and first-seen state run
once, in the query from there to the raw table. Features, curated events and host counts
read that table as a file stream, so the costly state is not repeated for each sink.

A sink of several tables writes each micro-batch under its number and in place of what a
run before left there, so a micro-batch that is repeated after a kill changes nothing.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatewatch import schemas
from gatewatch.config import PipelineConfig, StreamConfig
from gatewatch.functions.risk import apply_risk_engine
from gatewatch.functions.times import event_date
from gatewatch.operators.rollups import hosts_of_visits
from gatewatch.plans.curated import CURATED_COLUMNS
from gatewatch.plans.tables import make_folder
from gatewatch.session import prepare
from gatewatch.sources.validate import dead_letters, valid_events, with_processing_metadata
from gatewatch.streaming.commits import DayCommits, commit_finished
from gatewatch.streaming.features import stream_enriched, stream_features
from gatewatch.streaming.firstseen import flag_new_devices_stream
from gatewatch.streaming.sources import read_payloads, validated_stream

_PARTITIONS = "spark.sql.shuffle.partitions"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """RocksDB keeps state off the heap; change logs make its commits cheap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return prepare(spark)


def start_sink(
    df: DataFrame, path: str, partitions: list[str], checkpoint: str, cfg: StreamConfig, name: str | None = None
) -> StreamingQuery:
    """Append ``df`` to a partitioned Parquet table, exactly once per checkpoint."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    if name:
        writer = writer.queryName(name)
    if cfg.trigger_once:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{cfg.trigger_seconds} seconds")
    with _state_partitions(df.sparkSession, cfg):
        return writer.start()


@contextmanager
def _state_partitions(spark: SparkSession, cfg: StreamConfig):
    """A query takes the session's settings over when it starts."""
    before = spark.conf.get(_PARTITIONS)
    if cfg.state_partitions:
        spark.conf.set(_PARTITIONS, str(cfg.state_partitions))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


def unique_stream(events: DataFrame, watermark: str) -> DataFrame:
    """One event per id within the watermark; older ids are forgotten."""
    return events.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_id"])


def flagged_stream(events: DataFrame, cfg: StreamConfig, history: DataFrame | None = None) -> DataFrame:
    return flag_new_devices_stream(
        unique_stream(events, cfg.watermark), cfg.state_shards, cfg.state_ttl, history
    )


def curated_stream(flagged: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Rows of the curated table from flagged, watermarked events.

    Which hosts are the day's least visited is known at the day's end only, so that mode
    of the rare-host rule is left to batch builds.
    """
    if cfg.risk.rare_host_mode != "new_device":
        raise ValueError("a stream cannot rank a day's hosts before it ends; rare_host_mode must be new_device")
    enriched = stream_enriched(flagged, cfg.hour_hop, cfg.day_hop)
    counts = ["window_1h_event_count", "window_1h_unique_hosts", "window_24h_unique_hosts"]
    filled = enriched.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0)) for c in counts},
            "has_new_device": F.coalesce("has_new_device", F.lit(False)),
            "success": F.coalesce("success", F.lit(True)),
        }
    ).withColumnRenamed("computer_id", "dst_host")
    return apply_risk_engine(filled, cfg.risk).withColumn("event_date", event_date()).select(*CURATED_COLUMNS)


def stored_stream(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The raw table as a watermarked stream.

    No bound on files here: a commit of the raw table holds files of many days, and taking
    some of them first would make the others late.
    """
    return spark.readStream.schema(schemas.RAW_STORED).parquet(cfg.tables.raw).withWatermark(
        "event_time", cfg.stream.watermark
    ).drop("event_date")


def landed_stream(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Valid events between the source and the raw table, in the order and portions they came.

    A portion of the source is one folder here, so a bound on files bounds this stage too.
    """
    reader = spark.readStream.schema(schemas.LANDED)
    if cfg.stream.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.stream.max_files_per_trigger)
    return reader.parquet(cfg.tables.landing).drop("batch")


def _checkpoint(cfg: PipelineConfig, query: str) -> str:
    base = cfg.stream.checkpoint_location or cfg.tables.path("checkpoint")
    return f"{base.rstrip('/')}/{query}"


def _start_batches(df: DataFrame, write, checkpoint: str, cfg: StreamConfig) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if cfg.trigger_once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{cfg.trigger_seconds} seconds").start()


def _replace_portion(df: DataFrame, path: str, batch: int, partitions: tuple[str, ...] = ()) -> None:
    """Write a micro-batch's portion of a table under its number, whatever a run before left there."""
    portion = df.withColumn("batch", F.lit(batch).cast("long"))
    (
        portion.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch", *partitions)
        .parquet(path)
    )


def start_landing(spark: SparkSession, cfg: PipelineConfig) -> StreamingQuery:
    """The source, read and decoded once: valid events to the landing folder, rejected records to the dead letters."""
    validated = validated_stream(read_payloads(spark, cfg.stream), cfg.stream.payload_format)

    def split(batch: DataFrame, number: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = valid_events(batch).select(*[c for c in schemas.LANDED.names if c != "batch"])
            _replace_portion(_small_files(events, cfg.stream), cfg.tables.landing, number)
            rejected = dead_letters(batch).withColumn("processing_time", F.current_timestamp())
            _replace_portion(rejected, cfg.tables.dead_letters, number)
        finally:
            batch.unpersist()

    return _start_batches(validated, split, _checkpoint(cfg, "landing"), cfg.stream)


def _small_files(events: DataFrame, cfg: StreamConfig) -> DataFrame:
    """With a bound on files a portion is kept in one file, which is what the bound counts."""
    return events.coalesce(1) if cfg.max_files_per_trigger else events


def start_raw(spark: SparkSession, cfg: PipelineConfig, history: DataFrame | None = None) -> StreamingQuery:
    """Landed events to the raw table, one per id and flagged."""
    flagged = flagged_stream(landed_stream(spark, cfg), cfg.stream, history)
    return start_sink(
        with_processing_metadata(flagged),
        cfg.tables.raw,
        ["event_date"],
        _checkpoint(cfg, "raw"),
        cfg.stream,
    )


def start_ingest(
    spark: SparkSession, cfg: PipelineConfig, history: DataFrame | None = None
) -> list[StreamingQuery]:
    """Source to raw table, and rejected records to the dead-letter table."""
    landing = start_landing(spark, cfg)
    if cfg.stream.trigger_once:
        landing.awaitTermination()
    # A file stream needs its folder to exist before the first portion.
    make_folder(spark, cfg.tables.landing)
    return [start_raw(spark, cfg, history), landing]


def start_features(spark: SparkSession, cfg: PipelineConfig) -> StreamingQuery:
    features = stream_features(stored_stream(spark, cfg), [cfg.hour_hop, cfg.day_hop])
    return start_sink(
        features.withColumn("event_date", event_date("window_start")),
        cfg.tables.features,
        ["event_date", "window_size"],
        _checkpoint(cfg, "features"),
        cfg.stream,
    )


def start_curated(spark: SparkSession, cfg: PipelineConfig) -> StreamingQuery:
    return start_sink(
        curated_stream(stored_stream(spark, cfg), cfg),
        cfg.tables.curated,
        ["event_date"],
        _checkpoint(cfg, "curated"),
        cfg.stream,
    )


def start_host_popularity(spark: SparkSession, cfg: PipelineConfig) -> StreamingQuery:
    """Host counts of every day touched by a micro-batch.

    A micro-batch adds its visits, counted per day, host and user; a touched day's hosts are
    counted again from its visits, not from its events.
    """
    visits_path = cfg.tables.path("state/host_visits")

    def recount(batch: DataFrame, number: int) -> None:
        visits = batch.groupBy("event_date", "computer_id", "user_id").agg(F.count(F.lit(1)).alias("visits"))
        _replace_portion(visits, visits_path, number, ("event_date",))
        touched = F.broadcast(batch.select("event_date").distinct())  # one row per calendar day
        stored = spark.read.schema(schemas.HOST_VISITS).parquet(visits_path).join(touched, "event_date", "left_semi")
        (
            hosts_of_visits(stored)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date")
            .parquet(cfg.tables.path("aggregates/host_access_daily"))
        )

    source = spark.readStream.schema(schemas.RAW_STORED).parquet(cfg.tables.raw)
    return _start_batches(source, recount, _checkpoint(cfg, "host_popularity"), cfg.stream)


def start_pipeline(
    spark: SparkSession, cfg: PipelineConfig, history: DataFrame | None = None
) -> list[StreamingQuery]:
    """Start all queries. With ``trigger_once`` each stage ends before the next starts."""
    if cfg.tables is None:
        raise ValueError("cfg.tables names where the tables are")
    if cfg.risk.rare_host_mode != "new_device":
        raise ValueError("rare_host_mode must be new_device on a stream")
    prepare_streaming(spark)
    queries = start_ingest(spark, cfg, history)
    if cfg.stream.trigger_once:
        for query in queries:
            query.awaitTermination()
        commit_finished(spark, cfg, queries[0])
    else:
        # A file stream needs its folder to exist before the first raw commit.
        make_folder(spark, cfg.tables.raw)
        spark.streams.addListener(DayCommits(spark, cfg, queries[0]))
    behind = [start_features(spark, cfg), start_curated(spark, cfg), start_host_popularity(spark, cfg)]
    if cfg.stream.trigger_once:
        for query in behind:
            query.awaitTermination()
    return queries + behind


def run(spark: SparkSession, cfg: PipelineConfig, history: DataFrame | None = None) -> None:
    """Start the pipeline and wait; returns at once when everything was processed."""
    queries = start_pipeline(spark, cfg, history)
    if not cfg.stream.trigger_once:
        spark.streams.awaitAnyTermination()
    for query in queries:
        if query.exception() is not None:
            raise query.exception()
