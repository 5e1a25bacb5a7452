"""Shared steps of the corpus operators: lineage cuts, checked broadcasts, size estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.session import materialize, shared_dir

#: A side of a join is broadcast by hint only below this many bytes, measured beforehand.
BROADCAST_BYTES = 16 << 20

#: Words of a text: runs without space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later steps survive lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def small_side(df: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows fit ``limit``; else as it is.

    ``row_bytes`` is the size of every row, or a column that measures each (rows with lists,
    maps or strings of any length). ``df`` should be cut, since it is read here.
    """
    if isinstance(row_bytes, Column):
        held = df.agg(F.sum(row_bytes)).first()[0] or 0
    else:
        held = df.count() * row_bytes
    return F.broadcast(df) if held <= limit else df


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text is a multiple of five.

    A NULL id counts as held out, since its remainder is unknown.
    """
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(True))


def bounded_sample(rows: DataFrame, key: str, limit: int, by: str, seed: int = 1) -> DataFrame:
    """At most about ``limit`` rows, the same share of rows of every value of ``by`` beyond an even quota.

    A row is in by a hash of its key, so reruns and other partitionings agree. The hash
    threshold comes from one grouped count; nothing is sorted or collected but one row per
    value of ``by`` (a label, of which there are few).
    """
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}
    if not counts:
        return rows
    quota, left, share = {}, limit, len(counts)
    for value in sorted(counts, key=lambda v: (counts[v], str(v))):
        quota[value] = min(1.0, left / share / counts[value])
        left -= counts[value] * quota[value]
        share -= 1
    chance = F.lit(0.0)
    for value, part in quota.items():
        chance = F.when(F.col(by).eqNullSafe(F.lit(value)), F.lit(part)).otherwise(chance)
    draw = (F.xxhash64(F.col(key).cast("string"), F.lit(seed)) / F.lit(2.0**64)) + 0.5
    return rows.where(draw < chance)


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again."""
    return materialize(df, label)
