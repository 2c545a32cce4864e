"""Running lifecycle status per key over a stream of commands.

Two engines with the same semantics:

- ``"fold"`` (default, no Python worker): each micro-batch is folded with the
  set-based ``fold_transitions`` starting from the per-key state left by
  earlier batches, which lives in a ``batch_id``-partitioned state table.
  Suited to scheduled ``availableNow`` runs of a few batches; every batch
  reads the state rows of its own keys.
- ``"state-store"``: ``groupBy(key).applyInPandasWithState`` keeps
  ``(status, moves, last seen position)`` per key in Spark's state store,
  which suits an always-on stream with many small batches.

In both engines a micro-batch's commands are applied per key in ``(ts, seq)``
order from the stored state; a command at or before the last position
already seen for its key arrives too late to be ordered correctly and is
counted in ``late`` instead of being applied (the reference never defines
this case). The fold engine never gathers a key's rows (min aggregates, as
in the batch fold); the state-store engine hands a key's rows of one
micro-batch to Python, bounded by the trigger size (``maxFilesPerTrigger``),
never by the key's whole history.

Each micro-batch's updated keys go to a ``batch_id=N`` sink directory
(overwrite), so a replayed batch replaces its output; the current state is
the latest row per key across batches.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.operators.lifecycle import fold_transitions
from tidemark.session import scratch_path, spread
from tidemark.streaming.incremental import run_id

OUTPUT_SCHEMA = ("key string, status string, moves long, last_ts timestamp, last_seq long, "
                 "late long")
STATE_SCHEMA = "status string, moves long, seen_ts timestamp, seen_seq long, last_ts timestamp, " \
               "last_seq long, late long"


def make_step(relation: Mapping[str, Sequence[str]], start: str):
    """The per-key state function for ``applyInPandasWithState``."""
    legal = {(s, t) for s, ts in relation.items() for t in ts}

    def step(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.exists:
            status, moves, seen_ts, seen_seq, last_ts, last_seq, late = state.get
        else:
            status, moves, seen_ts, seen_seq, last_ts, last_seq, late = start, 0, None, None, None, None, 0
        frames = list(pdfs)
        batch = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        ts_arr = batch["ts"].to_numpy()
        seq_arr = batch["seq"].to_numpy()
        order = np.lexsort((seq_arr, ts_arr))  # by ts, then seq
        tss, seqs, targets = ts_arr[order], seq_arr[order].tolist(), batch["target"].to_numpy()[order]
        seen = None if seen_ts is None else (np.datetime64(pd.Timestamp(seen_ts)), seen_seq)
        for i, target in enumerate(targets.tolist()):
            pos = (tss[i], seqs[i])
            if seen is not None and pos <= seen:
                late += 1
                continue
            seen = pos
            if (status, target) in legal:
                status, moves, last_ts, last_seq = target, moves + 1, pos[0], pos[1]
        if seen is not None:
            seen_ts, seen_seq = pd.Timestamp(seen[0]), int(seen[1])
        if last_ts is not None:
            last_ts = pd.Timestamp(last_ts)
        state.update((status, int(moves), seen_ts, seen_seq, last_ts,
                      None if last_seq is None else int(last_seq), int(late)))
        yield pd.DataFrame({
            "key": [key[0]], "status": [status], "moves": [int(moves)],
            "last_ts": [last_ts], "last_seq": [None if last_seq is None else int(last_seq)],
            "late": [int(late)],
        })

    return step


def lifecycle_stream(commands: DataFrame, relation: Mapping[str, Sequence[str]],
                     start: str) -> DataFrame:
    """Streaming (or batch) ``key, ts, seq, target`` -> per-key state updates."""
    return commands.groupBy("key").applyInPandasWithState(
        make_step(relation, start), OUTPUT_SCHEMA, STATE_SCHEMA, "update",
        GroupStateTimeout.NoTimeout)


def stored_updates(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """The updates of earlier batches; none before the first. A sink that cannot
    be read is an error, not an empty state."""
    try:
        prior = spark.read.schema(schema).parquet(sink)
        prior.schema
        return prior
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def refuse_other_runs(spark: SparkSession, sink: str, run: str) -> None:
    """A new checkpoint reads every command again, and numbers its batches from 0:
    on the state of another run they would be late, or overwrite it."""
    others = stored_updates(spark, sink, "run string").where(F.coalesce(F.col("run") != run, F.lit(True)))
    if not others.isEmpty():
        raise RuntimeError(f"{sink} holds the state of another checkpoint: start a new state with a new root")


def fold_batch(batch: DataFrame, batch_id: int, sink: str,
               relation: Mapping[str, Sequence[str]], start: str, run: str = "direct") -> None:
    """One micro-batch of the ``"fold"`` engine (JVM only, set-based).

    Reads the latest state of the batch's keys from earlier batches, counts
    commands at or before a key's last seen position as late, folds the rest
    from that state, and writes the updated keys as ``batch_id=N``.
    """
    spark = batch.sparkSession
    ts_t = batch.schema["ts"].dataType.simpleString()
    seq_t = batch.schema["seq"].dataType.simpleString()
    schema = (f"key string, status string, moves long, last_ts {ts_t}, last_seq {seq_t}, "
              f"seen_ts {ts_t}, seen_seq {seq_t}, late long, batch_id long")
    prior = stored_updates(spark, sink, schema)
    cmds = spread(batch.select("key", "ts", "seq", "target")).persist(StorageLevel.MEMORY_AND_DISK)
    keys = cmds.select("key").distinct()
    old = current_state(prior.where(F.col("batch_id") < batch_id)).join(keys, "key", "left_semi")
    marked = cmds.join(old.select("key", "seen_ts", "seen_seq"), "key", "left").withColumn(
        "_late", F.coalesce(F.struct("ts", "seq") <= F.struct("seen_ts", "seen_seq"), F.lit(False)))
    on_time = marked.where(~F.col("_late")).select("key", "ts", "seq", "target")
    seen = marked.groupBy("key").agg(
        F.count_if("_late").cast("long").alias("n_late"),
        F.max(F.when(~F.col("_late"), F.struct("ts", "seq"))).alias("pos"))
    initial = old.select("key", "status", "last_ts", "last_seq")
    state, _ = fold_transitions(on_time, relation, start=start, initial=initial)
    prev = old.select("key", F.col("moves").alias("m0"), "seen_ts", "seen_seq",
                      F.col("late").alias("l0"))
    out = state.join(seen, "key").join(prev, "key", "left").select(
        "key", "status",
        (F.coalesce("m0", F.lit(0)) + F.col("moves")).cast("long").alias("moves"),
        "last_ts", "last_seq",
        F.coalesce(F.col("pos.ts"), F.col("seen_ts")).alias("seen_ts"),
        F.coalesce(F.col("pos.seq"), F.col("seen_seq")).alias("seen_seq"),
        (F.coalesce("l0", F.lit(0)) + F.col("n_late")).cast("long").alias("late"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )
    out.drop("batch_id").withColumn("run", F.lit(run)).write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))
    cmds.unpersist()


def run_lifecycle_stream(
    spark: SparkSession,
    source_dir: str,
    schema: str,
    relation: Mapping[str, Sequence[str]],
    start: str,
    files_per_trigger: int = 2,
    root: str | None = None,
    engine: str = "fold",
) -> str:
    """Drain ``source_dir`` (parquet commands) through the stateful fold; returns the sink path."""
    root = root or scratch_path(spark, "lifecycle", uuid.uuid4().hex[:12])
    sink = os.path.join(root, "updates")
    commands = spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", files_per_trigger).parquet(source_dir)

    checkpoint = os.path.join(root, "checkpoint")
    runs: list[str] = []

    def run() -> str:
        if not runs:
            runs.append(run_id(spark, checkpoint))
            refuse_other_runs(spark, sink, runs[0])
        return runs[0]

    def write(df: DataFrame, batch_id: int) -> None:
        df.withColumn("run", F.lit(run())).write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    if engine == "fold":
        writer = commands.writeStream.foreachBatch(
            lambda df, bid: fold_batch(df, bid, sink, relation, start, run()))
    elif engine == "state-store":
        writer = (lifecycle_stream(commands, relation, start).writeStream
                  .outputMode("update").foreachBatch(write))
    else:
        raise ValueError(f"unknown engine {engine!r}")
    q = (writer
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()
    return sink


def current_state(updates: DataFrame) -> DataFrame:
    """Latest update per key across batches (a partial ``max_by`` aggregate).

    ``batch_id`` comes from the ``batch_id=N`` directory names."""
    cols = [c for c in updates.columns if c not in ("key", "batch_id", "run")]
    agg = updates.groupBy("key").agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("s"))
    return agg.select("key", *[F.col(f"s.{c}").alias(c) for c in cols])
