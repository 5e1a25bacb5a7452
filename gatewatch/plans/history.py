"""The stored history of seen pairs: a bucketed table, merged and read without shuffling it.

Pairs are laid out by a hash of (user, host) into as many buckets as the session that
began the table had shuffle partitions. Merging a day shuffles the day's pairs to those
buckets and appends; readers take the earliest and latest time of a pair within its bucket.
Appended rows are folded by writing a new generation beside the old one; readers take the
latest complete generation, so a fold that dies halfway changes nothing.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch import schemas
from gatewatch.config import TablePaths
from gatewatch.operators.firstseen import PAIR, merge_seen_pairs
from gatewatch.plans.tables import list_folder

_GENERATION = re.compile(r"g(\d+)-b(\d+)$")


def _generations(spark: SparkSession, tables: TablePaths) -> list[tuple[int, int]]:
    """Number and buckets of all complete generations, the oldest first."""
    found = []
    for name in list_folder(spark, tables.seen_pairs):
        match = _GENERATION.match(name)
        if match and "_SUCCESS" in list_folder(spark, f"{tables.seen_pairs}/{name}"):
            found.append((int(match[1]), int(match[2])))
    return sorted(found)


def _declared(spark: SparkSession, tables: TablePaths, number: int, buckets: int) -> str:
    """Name of the catalog table over one generation; declared anew in each session that asks."""
    path = f"{tables.seen_pairs}/g{number:06d}-b{buckets}"
    name = f"seen_pairs_{zlib.crc32(path.encode()):08x}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SEEN_PAIRS.fields)
    keys = ", ".join(PAIR)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(name)  # another session may have appended
    return name


def _session_buckets(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def stored_pairs(spark: SparkSession, tables: TablePaths) -> DataFrame | None:
    """Rows as appended, several per pair; None before anything was stored."""
    found = _generations(spark, tables)
    return spark.table(_declared(spark, tables, *found[-1])) if found else None


def known_pairs(spark: SparkSession, tables: TablePaths) -> DataFrame:
    """One row per pair, with the times it was first and last seen; no exchange is needed."""
    stored = stored_pairs(spark, tables)
    return spark.createDataFrame([], schemas.SEEN_PAIRS) if stored is None else merge_seen_pairs(stored)


def append_pairs(spark: SparkSession, tables: TablePaths, found: DataFrame) -> None:
    """Add the pairs that widen what is known of them; adding the same again changes nothing."""
    generations = _generations(spark, tables)
    number, buckets = generations[-1] if generations else (1, _session_buckets(spark))
    if generations:
        known = known_pairs(spark, tables).select(*PAIR, F.col("first_seen").alias("_first"), F.col("last_seen").alias("_last"))
        wider = F.col("_first").isNull() | (F.col("first_seen") < F.col("_first")) | (F.col("last_seen") > F.col("_last"))
        found = found.join(known, PAIR, "left").filter(wider).drop("_first", "_last")
    _write(found, _declared(spark, tables, number, buckets), buckets)


def fold_pairs(spark: SparkSession, tables: TablePaths) -> None:
    """Write a new generation with one row per pair, in buckets of this session's number."""
    generations = _generations(spark, tables)
    if generations:
        folded = known_pairs(spark, tables)
        buckets = _session_buckets(spark)
        _write(folded, _declared(spark, tables, generations[-1][0] + 1, buckets), buckets)


def _write(pairs: DataFrame, name: str, buckets: int) -> None:
    # One task per bucket writes one file.
    names = [f.name for f in schemas.SEEN_PAIRS.fields]
    pairs.select(*names).repartition(buckets, *PAIR).write.insertInto(name)
