"""Authentication logs as text: ``time,user,computer`` per line, time in seconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatewatch.functions.ids import hashed_event_id, joined_event_id
from gatewatch.functions.times import epoch_to_time
from gatewatch.session import materialize
from gatewatch.sources.validate import first_reason, stripped

LINE_NUMBER = "line_number"
FILE = "log_file"

#: File blocks whose line counts are broadcast; beyond, lines are joined with them by block.
BROADCAST_BLOCKS = 1_000_000


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of plain or compressed (``.bz2``, ``.gz``) files, split across tasks.

    Text and not CSV, because a quote character has no meaning in these logs.
    """
    return spark.read.text(path)


def number_lines(lines: DataFrame) -> DataFrame:
    """Append the 0-based line number within each file and the file, without a global sort.

    Rows are numbered within their file block; the blocks' line counts, one small row
    per block, then give each block its offset. These are counted beforehand and stored,
    so that the text itself is not shuffled while they fit a broadcast. Both scans split
    files alike as long as the files and the session's file settings stay the same.
    """
    placed = lines.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    blocks = placed.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_lines"), F.min("_row").alias("_first")
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_file",
        "_block",
        "_first",
        F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_offset"),
    )
    offsets = materialize(offsets, "line-offsets")
    if offsets.count() <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    return (
        placed.join(offsets, ["_file", "_block"])
        .withColumn(LINE_NUMBER, F.col("_offset") + F.col("_row") - F.col("_first"))
        .withColumnRenamed("_file", FILE)
        .drop("_block", "_row", "_first", "_offset")
    )


def _event_id(kind: str, time: Column, user: Column, computer: Column) -> Column:
    if kind == "hash":
        return hashed_event_id(time, user, computer)
    if kind == "joined":
        return joined_event_id(time, user, computer)
    if kind == "joined_line":
        return joined_event_id(time, user, computer, (F.col(LINE_NUMBER) + 1).cast("string"))
    raise ValueError(f"unknown event id kind {kind!r}")


def parse_lines(
    lines: DataFrame, base_epoch: int = 0, event_id: str = "hash", keep: Sequence[str] = ()
) -> DataFrame:
    """Parse the ``value`` column of ``lines`` into events with a ``reject_reason``.

    Blank lines and a header are no records and are left out; every other line is kept,
    bad ones with the reason. ``keep`` names columns of ``lines`` to carry along.
    """
    text = stripped("value")
    parts = F.split(text, ",", -1)
    carried = [c for c in lines.columns if c == LINE_NUMBER or c in keep]
    fields = lines.filter(text != "").select(
        F.col("value"),
        *carried,
        F.size(parts).alias("_n"),
        stripped(F.get(parts, F.lit(0))).alias("_time"),
        stripped(F.get(parts, F.lit(1))).alias("_user"),
        stripped(F.get(parts, F.lit(2))).alias("_computer"),
    )
    records = fields.filter((F.col("_n") != 3) | (F.lower("_time") != "time"))
    reason = first_reason(
        (F.col("_n") != 3, "field_count"),
        (~F.col("_time").rlike("^[0-9]+$"), "time_not_digits"),
        (epoch_to_time(F.col("_time"), base_epoch).isNull(), "time_out_of_range"),
        (F.col("_user") == "", "blank_user_id"),
        (F.col("_computer") == "", "blank_computer_id"),
    )
    return records.select(
        epoch_to_time(F.col("_time"), base_epoch).alias("event_time"),
        F.col("_user").alias("user_id"),
        F.lit(None).cast("string").alias("src_host"),
        F.col("_computer").alias("computer_id"),
        F.lit(True).alias("success"),
        _event_id(event_id, F.col("_time"), F.col("_user"), F.col("_computer")).alias("event_id"),
        F.col("value").alias("raw_line"),
        reason.alias("reject_reason"),
        *keep,
    )


def read_log(
    spark: SparkSession,
    path: str | list[str],
    start_line: int = 0,
    max_events: int | None = None,
    base_epoch: int = 0,
    event_id: str = "hash",
) -> DataFrame:
    """Valid events of a log, optionally from a line on and at most ``max_events``.

    A bounded read takes the first events in order of file name and line.
    """
    lines = read_lines(spark, path)
    if start_line or event_id == "joined_line" or max_events is not None:
        lines = number_lines(lines).filter(F.col(LINE_NUMBER) >= start_line)
    keep = [] if max_events is None else [FILE, LINE_NUMBER]
    events = parse_lines(lines, base_epoch, event_id, keep).filter(F.col("reject_reason").isNull())
    events = events.drop("raw_line", "reject_reason")
    return events if max_events is None else events.orderBy(FILE, LINE_NUMBER).limit(max_events).drop(*keep)
