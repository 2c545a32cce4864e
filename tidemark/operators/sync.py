"""Changed-since filters, per-source high-water marks and keyset marks.

"Watermark" here is the persisted high-water mark of the last successful
sync, not Spark's event-time watermark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import bounded_broadcast

MARK_ROW_BOUND = 100_000


def ts_literal(mark: dt.datetime, dtype=None):
    """A timestamp literal from UTC text (naive values are UTC), typed as ``dtype``."""
    if mark.tzinfo is not None:
        mark = mark.astimezone(dt.timezone.utc).replace(tzinfo=None)
    lit = F.lit(mark.isoformat(sep=" "))
    return lit.cast(dtype) if dtype is not None else lit.cast("timestamp")


def changed_since(df: DataFrame, mark: dt.datetime | None, column: str = "source_updated_at",
                  inclusive: bool = False) -> DataFrame:
    """No mark -> every row (NULL times too); else strictly after the mark.

    Rows with NULL time are dropped once a mark exists. The comparison is on
    the raw column so Catalyst pushes it into the Parquet scan.
    ``inclusive`` keeps rows equal to the mark (safe: fingerprints dedupe).
    """
    if mark is None:
        return df
    c = F.col(column)
    # typed like the column (NTZ stays NTZ) so the filter reaches the scan
    lit = ts_literal(mark, df.schema[column].dataType)
    return df.where(c >= lit if inclusive else c > lit)


def next_watermark(df: DataFrame, mark: dt.datetime | None,
                   column: str = "source_updated_at") -> DataFrame:
    """One row ``next_watermark`` = max time seen, else the previous mark."""
    dtype = df.schema[column].dataType
    prev = ts_literal(mark, dtype) if mark is not None else F.lit(None).cast(dtype)
    return df.agg(F.coalesce(F.max(column), prev)
                  .alias("next_watermark"))


def changed_since_marks(df: DataFrame, marks: DataFrame, source: str = "source_system",
                        column: str = "source_updated_at") -> DataFrame:
    """A11 + C1 for many sources at once: each row against its source's mark.

    ``marks`` is ``(source, watermark)``, one row per source; it is
    broadcast only after a bounded count proves it small, so a hot source
    never concentrates the deal rows in one shuffle partition.
    """
    m = marks.select(F.col("source").alias("__src"), F.col("watermark").alias("__mark"))
    m = bounded_broadcast(m, MARK_ROW_BOUND)
    joined = df.join(m, F.col(source) == F.col("__src"), "left")
    keep = F.col("__mark").isNull() | (F.col(column) > F.col("__mark"))
    return joined.where(keep).drop("__src", "__mark")


def advance_marks(df: DataFrame, marks: DataFrame, source: str = "source_system",
                  column: str = "source_updated_at") -> DataFrame:
    """New ``(source, watermark)`` snapshot after a successful batch.

    ``max`` per source is computed with partial aggregation (a hot source
    costs one row per map task), then full-outer-joined to the old marks.
    A mark never moves backwards (``greatest``); a source with no new times
    keeps its mark.
    """
    seen = df.groupBy(F.col(source).alias("source")).agg(F.max(column).alias("__new"))
    old = marks.select("source", F.col("watermark").alias("__old"))
    return seen.join(old, "source", "full_outer").select(
        "source",
        F.greatest(F.col("__old"), F.col("__new").cast(old.schema["__old"].dataType)).alias("watermark"),
    )


SEEN_SCHEMA = "source string, watermark timestamp, id string"


def changed_since_keyset(df: DataFrame, marks: DataFrame, seen: DataFrame, source: str = "source_system",
                         column: str = "source_updated_at", record_id: str = "source_id") -> DataFrame:
    """C1 with ties: records after their source's mark, and those at the mark not read yet.

    A mark of time alone either loses a record that lands later with the mark's own
    time (strict) or reads the others at that time twice (inclusive). ``seen`` is
    ``(source, watermark, id)``: the ids already read at their source's mark. One
    scan; only rows at or after their mark meet ``seen``, in an anti join on source,
    id and time (a hot source is spread by its ids). A source without a mark gives
    every row; once it has one, NULL times are dropped, and a NULL source has no mark.
    A NULL id cannot be known again: its row at the mark is read on every sync.
    """
    m = bounded_broadcast(marks.select(F.col("source").alias("__src"), F.col("watermark").alias("__mark")), MARK_ROW_BOUND)
    joined = df.join(m, F.col(source) == F.col("__src"), "left")
    due = joined.where(F.col("__mark").isNull() | (F.col(column) >= F.col("__mark"))).drop("__src", "__mark")
    s = seen.select(F.col("source").alias("__src"), F.col("watermark").alias("__mark"), F.col("id").alias("__id"))
    known = (F.col(source) == F.col("__src")) & (F.col(record_id).cast("string") == F.col("__id")) & (F.col(column) == F.col("__mark"))
    return due.join(s, known, "left_anti")


def advance_keyset(changed: DataFrame, marks: DataFrame, seen: DataFrame, source: str = "source_system",
                   column: str = "source_updated_at", record_id: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """A10 with ties: ``(marks, seen)`` after the rows ``changed`` were read.

    Marks advance as in ``advance_marks``. A source whose mark moved keeps only the ids
    at the new mark; one whose mark stayed adds to the ids that it had. ``seen`` holds
    one instant per source, so it does not grow with history.
    """
    moved = advance_marks(changed.where(F.col(source).isNotNull() & F.col(column).isNotNull()), marks, source, column)
    m = bounded_broadcast(moved.select(F.col("source").alias("__src"), F.col("watermark").alias("__mark")), MARK_ROW_BOUND)
    read = changed.select(F.col(source).alias("source"), F.col(column).cast(seen.schema["watermark"].dataType).alias("watermark"),
                          F.col(record_id).cast("string").alias("id")).where("id is not null")
    at_mark = (F.col("source") == F.col("__src")) & (F.col("watermark") == F.col("__mark"))
    ids = read.unionByName(seen.select("source", "watermark", "id")).join(m, at_mark, "left_semi")
    return moved, ids.dropDuplicates()
