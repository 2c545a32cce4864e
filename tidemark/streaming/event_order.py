"""K4: lifecycle commands applied in event-time order, whatever batch they arrive in.

A command waits until the watermark (greatest time seen so far, less ``delay``)
has passed it; then all that wait up to the watermark are folded together in
``(ts, seq)`` order from the state left by earlier batches. Arrival in any order
within ``delay`` therefore gives the batch replay. A command at or before the
watermark of the batches before it comes too late: what followed it has been
applied. It goes to the ``late`` sink whole and changes nothing, as does one
without a time. A command without a key is a heartbeat: it moves the watermark.

Nothing is gathered by key: the waiting commands are a table, the fold is the
set-based one, and the watermark is one value. Each batch rewrites the waiting
table, which holds ``delay``'s worth of commands, so a hot key's wait is spread
like any other rows. Every sink has a directory per batch (overwritten on replay)
and a batch reads only those before it, so a replayed batch gives the same rows.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import spread
from tidemark.streaming import lifecycle_state as L
from tidemark.streaming.incremental import run_id

COLUMNS = ("key", "ts", "seq", "target")
CLOCK_SCHEMA = "mark timestamp, run string, batch_id long"


def _at(root: str, sink: str, batch_id: int | None = None) -> str:
    path = os.path.join(root, sink)
    return path if batch_id is None else os.path.join(path, f"batch_id={batch_id}")


def _put(df: DataFrame, root: str, sink: str, batch_id: int, run: str) -> None:
    df.withColumn("run", F.lit(run)).write.mode("overwrite").parquet(_at(root, sink, batch_id))


def ordered_batch(batch: DataFrame, batch_id: int, root: str, relation: Mapping[str, Sequence[str]],
                  start: str, delay: str, run: str = "direct") -> None:
    """One micro-batch: late rows aside, the rest joins those that wait, and what
    the new watermark has passed is folded."""
    spark = batch.sparkSession
    schema = ", ".join(f"{c} {batch.schema[c].dataType.simpleString()}" for c in COLUMNS)
    clocks = L.stored_updates(spark, _at(root, "clock"), CLOCK_SCHEMA).where(F.col("batch_id") < batch_id)
    last = clocks.agg(F.max("mark").alias("mark"), F.max("batch_id").alias("batch_id")).first()
    came = spread(batch.select(*COLUMNS)).persist(StorageLevel.MEMORY_AND_DISK)
    # plain expressions on literals: the mark stays a column of the session's time zone
    newest = came.agg(F.max("ts").alias("ts")).select((F.col("ts") - F.expr(f"INTERVAL {delay}")).alias("ts")).first().ts
    before = F.lit(last.mark).cast("timestamp")
    mark = F.greatest(before, F.lit(newest).cast("timestamp"))  # skips nulls: a mark never goes back
    is_late = F.coalesce(F.col("ts") <= before, F.col("ts").isNull())
    commands = came.where("key IS NOT NULL")
    waiting = commands.where(~is_late)
    if last.batch_id is not None:
        held = L.stored_updates(spark, _at(root, "waiting"), f"{schema}, batch_id long")
        waiting = waiting.unionByName(held.where(F.col("batch_id") == last.batch_id).drop("batch_id"))
    passed = F.coalesce(F.col("ts") <= mark, F.lit(False))
    _put(commands.where(is_late), root, "late", batch_id, run)
    _put(waiting.where(~passed), root, "waiting", batch_id, run)
    L.fold_batch(waiting.where(passed), batch_id, _at(root, "updates"), relation, start, run)
    # written last: a batch without it has not happened
    _put(spark.range(1).select(mark.alias("mark")), root, "clock", batch_id, run)
    came.unpersist()


def run_ordered(spark: SparkSession, source_dir: str, schema: str, relation: Mapping[str, Sequence[str]], start: str,
                root: str, delay: str = "1 DAY", files_per_trigger: int | None = None) -> str:
    """Drain what has landed (Parquet commands) since the last call with this ``root``.

    Returns the sink of status updates (see ``lifecycle_state.current_state``);
    ``late`` and ``waiting`` lie beside it."""
    checkpoint, sink = os.path.join(root, "checkpoint"), _at(root, "updates")
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    runs: list[str] = []

    def one(batch: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(run_id(spark, checkpoint))
            L.refuse_other_runs(spark, sink, runs[0])
        ordered_batch(batch, batch_id, root, relation, start, delay, runs[0])

    q = (reader.parquet(source_dir).writeStream.foreachBatch(one)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def late_commands(spark: SparkSession, root: str) -> DataFrame:
    """The commands that came too late, once each time they came."""
    return spark.read.parquet(_at(root, "late")).select(*COLUMNS)
