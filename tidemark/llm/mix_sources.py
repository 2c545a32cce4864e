"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source whose target is ``r`` times its size gives ``floor(r)`` complete
epochs first; the fraction of an epoch that is left is a weighted sample
without replacement: each document draws an exponential key divided by its
quality weight, documents are taken in key order, and sizes are prefix-summed
up to the rest of the budget. Keys come from a hash of the row, so reruns
agree. Every step is a DataFrame expression.

No source is sorted as a whole. Keys fall into ranges (the exponential
distribution function of the key at the source's mean weight, cut into equal
parts, about ``ROWS_PER_RANGE`` rows each); sizes are summed per range with
partial aggregation, ranges are prefix-summed, and only the one range of a
source in which its budget ends is sorted. The window over ranges has one row
per range, that over rows only the distinct places of one range per source, so
a source with a third of all rows is never in one task.

Rows of equal id and text (repeated rows, null ids of one text) share a place
in the order. They are summed as one place before the window, and of the place
at which the budget ends only as many rows are taken as fit, numbered per task
with prefix sums over tasks, so a place with a third of all rows is in no one
task either. That step runs only where such a place is split.

Bound on sources: targets need all sources in one order, and the windows of
``source_targets`` have no partition key, so one task sorts one narrow row per
source. That suits sources as named collections, up to about a million (an
estimate, not measured); no row is lost beyond it. A source per host or
per page is no use for this operator: group such sources first.

Targets: sources are ranked by code point, null last, and take the weights in
turn; they share ``share`` times all sizes. A target stops at ``cap`` times its
source's size and the excess is reshared by weight until none is above, which
is a prefix sum in the order of cap over weight. All sums are whole numbers
until one final division.

Defined cases: a null text has size 0; a null, zero, negative or not finite
weight ranks its document after all others; a null source is a source of its
own; repeated rows (equal id and text) count one by one, and which of them are
taken once more is not told apart; a source of size 0 has target 0; empty input
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import word_count, written

ROWS_PER_RANGE = 4096
WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
CAP = 2


def uniform_key(*parts: Column) -> Column:
    """A number in (0, 1) from the MD5 of the parts: the same on every run."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def letters_share(text: Column) -> Column:
    """Quality weight: the square of the share of characters that are no symbols."""
    n = F.length(text).cast("double")
    share = F.length(F.translate(text, "#*$%&|<>", "")).cast("double") / F.nullif(n, F.lit(0.0))
    return share * share


def source_targets(sized: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """(source, source_size, source_rows, mean_weight, target) of rows with source, size, weight."""
    per = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.count(F.lit(1)).alias("source_rows"),
        F.avg(F.when(F.col("usable"), F.col("weight"))).alias("mean_weight"),
    )
    # one row per source: the windows below are over sources, not documents
    place = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(place) - 1
    w = F.lit(weights[-1])
    for i, x in enumerate(weights[:-1]):
        w = F.when(turn % len(weights) == i, x).otherwise(w)
    per = per.select("*", w.cast("long").alias("w"), F.sum("source_size").over(W.partitionBy()).alias("total"))
    # caps are reached in the order of cap / weight: compare as whole numbers of size / weight
    order = W.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    since = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    left = share_percent * F.col("total") - 100 * cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    per = per.select("*", left.alias("left"), F.sum("w").over(since).alias("w_left"))
    capped = F.col("left") * F.col("w") >= 100 * cap * F.col("source_size") * F.col("w_left")
    per = per.withColumn("capped", capped)
    # the level at which the first source that is not capped stands holds for all after it
    free = F.when(~F.col("capped"), F.struct("left", "w_left"))
    per = per.withColumn("level", F.first(free, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    even = (F.col("w") * F.col("level.left")).cast("double") / (100 * F.col("level.w_left")).cast("double")
    target = F.when(F.col("capped"), (cap * F.col("source_size")).cast("double")).otherwise(even)
    return per.select("source", "source_size", "source_rows", "mean_weight", target.alias("target"))


def _sized(docs: DataFrame, id_col: str, quality) -> list[Column]:
    """Columns (id, source, size, weight, usable, draw, tie) of documents."""
    text = F.col("text")
    q = quality(text).cast("double")
    usable = F.coalesce((q > 0) & ~F.isnan(q) & (q < F.lit(float("inf"))), F.lit(False))
    return [
        F.col(id_col).alias("id"), F.col("source").alias("source"), word_count(text).alias("size"), q.alias("weight"), usable.alias("usable"),
        (-F.log(uniform_key(F.coalesce(F.col(id_col).cast("string"), F.md5(text))))).alias("draw"), F.xxhash64(text).alias("tie"),
    ]


def _order(row: str = "") -> Column:
    """The sampling order within a source, as one comparable value: key, then
    draw, id and text; no usable weight and null ids last."""
    c = (lambda n: F.col(f"{row}.{n}")) if row else F.col
    key = F.when(c("usable"), c("draw") / c("weight"))
    return F.struct(
        key.isNull().alias("late"), F.coalesce(key, F.lit(0.0)).alias("key"), c("draw").alias("draw"),
        c("id").isNull().alias("no_id"), c("id").alias("id"), c("tie").alias("tie"),
    )


def source_cuts(sized: DataFrame, *, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """(s, source_size, target, epochs, cut, take, ties) per source: all documents
    before ``cut`` in the sampling order (null: none) are taken once more than
    ``epochs`` times, and ``take`` of the ``ties`` documents whose place it is."""
    targets = written(source_targets(sized, weights, share_percent, cap), "mix-targets")
    targets = targets.select(
        F.col("source").alias("s"), "source_size", "source_rows", "mean_weight", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"),
    ).withColumn("rest", F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double"))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / ROWS_PER_RANGE)).cast("long")
    spread = 1 - F.exp(-F.col("draw") / F.col("weight") * F.col("mean_weight"))
    # documents without a usable weight come last, spread by their draw
    late = F.floor((1 - F.exp(-F.col("draw"))) * ranges) + ranges
    keyed = sized.join(targets, sized["source"].eqNullSafe(targets["s"])).withColumn(
        "range", F.when(F.col("usable"), F.least(F.floor(spread * ranges), ranges - 1)).otherwise(late).cast("long")
    )
    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("s2"), F.col("range").alias("r2"), "range_size",
        F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("start"),
    )
    # the budget ends in the range that starts before its end and reaches it
    ends = written(
        sums.join(targets, sums["s2"].eqNullSafe(targets["s"]))
        .where((F.col("start") < F.col("rest")) & (F.col("start") + F.col("range_size") >= F.col("rest")))
        .select("s2", "r2", "start"),
        "mix-ends",
    )
    # the prefix that comes nearest: a document is taken if its middle lies within the budget
    part = keyed.join(ends, F.col("source").eqNullSafe(F.col("s2")) & (F.col("range") == F.col("r2"))).withColumn("place", _order())
    # rows of one place have one size
    part = part.groupBy("source", "place").agg(F.count(F.lit(1)).alias("ties"), F.first("size").alias("size"), F.first("start").alias("start"), F.first("rest").alias("rest"))
    order = W.partitionBy("source").orderBy("place")
    done = F.col("start") + F.coalesce(F.sum(F.col("size") * F.col("ties")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # row j of a place, from 0, has its middle at done + j * size + size / 2
    fitting = F.floor((2 * F.col("rest") - 2 * F.col("done") - F.col("size")) / (2 * F.nullif("size", F.lit(0)))) + 1
    part = part.withColumn("done", done).where(2 * F.col("done") + F.col("size") <= 2 * F.col("rest"))
    part = part.withColumn("take", F.least("ties", F.coalesce(fitting, "ties")))
    inside = part.groupBy("source").agg(F.max(F.struct("place", "take", "ties")).alias("cut"))
    # a range of which nothing fits: the cut lies before its first document
    first = keyed.join(ends, F.col("source").eqNullSafe(F.col("s2")) & (F.col("range") < F.col("r2")))
    whole = F.struct(F.col("place"), F.lit(1).cast("long").alias("take"), F.lit(1).cast("long").alias("ties"))
    earlier = first.withColumn("place", _order()).groupBy("source").agg(F.max(whole).alias("cut"))
    cut = inside.unionByName(earlier).groupBy("source").agg(F.max("cut").alias("c")).withColumnRenamed("source", "s3")
    return written(
        targets.join(cut, F.col("s").eqNullSafe(F.col("s3")), "left")
        .select("s", "source_size", "target", "epochs", F.col("c.place").alias("cut"), "c.take", "c.ties"), "mix-cuts"
    )


def _taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (with a struct ``mixed`` of ``_sized``) with their source's columns
    and ``copies``, how often the mix takes each."""
    rows = rows.join(cuts, F.col("mixed.source").eqNullSafe(F.col("s")))
    place = _order("mixed")
    copies = lambda more: (F.col("epochs") + F.when(more, 1).otherwise(0)).cast("long")
    upto = F.col("cut").isNotNull() & (place <= F.col("cut"))
    if cuts.where("take < ties").isEmpty():
        return rows.withColumn("copies", copies(upto))
    split = F.coalesce((F.col("take") < F.col("ties")) & (place == F.col("cut")), F.lit(False))
    others = rows.where(~split).withColumn("copies", copies(upto))
    # rows of one place, numbered: per task, and tasks by prefix sums
    tied = written(rows.where(split).withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "mix-ties")
    tasks = tied.groupBy(F.col("s").alias("s4"), F.col("task").alias("t4")).agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("s4").orderBy("t4").rowsBetween(W.unboundedPreceding, -1)
    tasks = tasks.select("s4", "t4", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    tied = tied.withColumn("own", F.row_number().over(W.partitionBy("s", "task").orderBy("at")))
    tied = tied.join(tasks, F.col("s").eqNullSafe(F.col("s4")) & (F.col("task") == F.col("t4")))
    tied = tied.withColumn("copies", copies(F.col("before") + F.col("own") <= F.col("take")))
    return others.unionByName(tied.select(*others.columns))


def _cuts(docs: DataFrame, id_col: str, quality, **options) -> tuple[DataFrame, DataFrame]:
    sized = written(docs.select(*_sized(docs, id_col, quality)), "mix-sized")
    return sized, source_cuts(sized, **options)


def mix(docs: DataFrame, *, id_col: str = "doc_id", quality=letters_share, **options) -> DataFrame:
    """(id, size, source_size, target, taken, copies) of every document.

    ``taken`` is the number of words that the mix takes of the document,
    ``copies`` how many times it takes it.
    """
    sized, cuts = _cuts(docs, id_col, quality, **options)
    rows = _taken(sized.select(F.struct("*").alias("mixed")), cuts)
    return rows.select(
        F.col("mixed.id").alias(id_col), "mixed.size", "source_size", "target", (F.col("mixed.size") * F.col("copies")).alias("taken"), "copies"
    )


def mixed(docs: DataFrame, *, id_col: str = "doc_id", quality=letters_share, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Texts are read
    twice (once more for rows of a split place) and not shuffled: what is joined
    to them is one row per source."""
    cuts = _cuts(docs, id_col, quality, **options)[1]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(*_sized(docs, id_col, quality)).alias("mixed"))
    rows = _taken(rows, cuts).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select("row.*")
