"""Rate-bounded replay of a log into a folder of payload files, in event-time order.

A batch job first stages the log: events of all files are laid out by range of event time,
numbered behind the counts of earlier ranges, and stored by step, a step being as many
consecutive events as one trigger may admit. Nothing is sorted or numbered in one task.

The replay itself is a stream over a built-in source that counts. Each micro-batch turns its
numbers into steps and publishes one file per step, under the step's name, by a rename. The
source's checkpoint holds the position, so a replay that stops goes on where it stopped, and
a step published already is left as it is. A file source reads the folder in the order of
publication with ``maxFilesPerTrigger``; its event time then never runs backwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatewatch.plans.tables import _folder, balanced, list_folder
from gatewatch.session import materialize, scratch_path
from gatewatch.sources.payload import encode_payload

#: Names of published files.
_NAME = "step-{:012d}.json"


def stage_replay(events: DataFrame, path: str, events_per_step: int = 10_000, start_at: int = 0) -> int:
    """Store ``events`` by step in order of ``(event_time, event_id)``, from event ``start_at`` on; returns the number of steps."""
    if events_per_step < 1:
        raise ValueError("a step holds one event at least")
    order = ["event_time", "event_id"]
    laid = events.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    laid = materialize(laid, "replay-order")
    # One row per partition of the layout.
    counts = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    ranked = laid.withColumn("_own", own).join(F.broadcast(before), "_part").withColumn("rank", F.col("_before") + F.col("_own") - start_at)
    steps = ranked.filter(F.col("rank") >= 0).withColumn("step", F.floor(F.col("rank") / F.lit(events_per_step)).cast("long"))
    balanced(steps.drop("_part", "_own", "_before"), ["step"]).write.mode("overwrite").partitionBy("step").parquet(path)
    spark = events.sparkSession
    last = spark.read.parquet(path).agg(F.max("step")).first()[0]
    return 0 if last is None else last + 1


def _publish(spark: SparkSession, staged: str, target: str, step: int) -> None:
    """One file with the step's payloads, visible whole or not at all."""
    filesystem, place = _folder(spark, f"{target}/{_NAME.format(step)}")
    source, _ = _folder(spark, f"{staged}/step={step}")
    if filesystem.exists(place) or not source.exists(_):
        return
    draft = scratch_path(spark, "replay-step")
    rows = spark.read.parquet(f"{staged}/step={step}").orderBy("rank")
    encode_payload(rows).select("value").coalesce(1).write.text(draft)
    (name,) = [n for n in list_folder(spark, draft) if n.startswith("part-")]
    path = spark._jvm.org.apache.hadoop.fs.Path
    util, conf = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jsc.hadoopConfiguration()
    # Copied beside its place under a hidden name, since drafts may be on another file system.
    hidden = path(f"{target}/.{_NAME.format(step)}")
    drafts, _ = _folder(spark, draft)
    util.copy(drafts, path(f"{draft}/{name}"), filesystem, hidden, True, True, conf)
    filesystem.rename(hidden, place)
    drafts.delete(path(draft), True)


def start_replay(
    spark: SparkSession, staged: str, target: str, checkpoint: str, steps: int, steps_per_trigger: int = 1, trigger_seconds: float = 1.0
) -> StreamingQuery:
    """Publish the staged steps, at most ``steps_per_trigger`` every ``trigger_seconds``, until all are there.

    The rate is ``events_per_step * steps_per_trigger / trigger_seconds``. The query stops
    itself behind the last step; until then it can be stopped and started again at will.
    """
    filesystem, folder = _folder(spark, target)
    filesystem.mkdirs(folder)
    numbers = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", steps_per_trigger).load()
    holder: list[StreamingQuery] = []

    def publish(batch: DataFrame, _: int) -> None:
        for (step,) in sorted(batch.filter(F.col("value") < steps).select("value").collect()):
            _publish(batch.sparkSession, staged, target, step)
        if batch.filter(F.col("value") >= steps - 1).head(1) and holder:
            holder[0].stop()

    writer = numbers.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    holder.append(writer.trigger(processingTime=f"{int(trigger_seconds * 1000)} milliseconds").start())
    return holder[0]


def published(spark: SparkSession, target: str) -> int:
    """Steps published so far."""
    return len([n for n in list_folder(spark, target) if n.startswith("step-")])


def await_replay(spark: SparkSession, query: StreamingQuery, target: str, steps: int, timeout: float = 600.0) -> None:
    """Wait until all steps are published; raises what ended the replay before that."""
    import time

    until = time.monotonic() + timeout
    while published(spark, target) < steps:
        if query.exception() is not None:
            raise query.exception()
        if not query.isActive or time.monotonic() > until:
            raise RuntimeError(f"the replay ended at {published(spark, target)} of {steps} steps")
        query.awaitTermination(0.2)
    query.stop()
