"""J12 for any relation: ordered replay as a parallel prefix over state maps.

A stretch of a key's log is a map from the state before it to the state after
it and the moves made. Maps compose associatively, so stretches of one key are
folded apart, wherever they lie, and joined by a prefix scan:

1. One range shuffle sorts all commands by (key, ts, seq, target); a dense place
   numbers them (offsets per partition, known from one count of each).
2. Up: stretches of ``STRETCH`` places of a key become a map each; ``STRETCH``
   neighbouring maps one map, until a key has one map.
3. Down: each key's start state goes through its maps, level by level, so that
   every stretch knows the state that it meets, and then every command.

Levels grow with the logarithm of the largest key's log to the base
``STRETCH``: two for 65,536 commands, five for 10**12. Cycles and moves do not
count. No task holds more of a key than ``STRETCH`` rows at once, so a key with a
third of all commands is many small groups. The driver sees one count per
partition of the sort. ``lifecycle.fold_transitions`` stays the plan for acyclic
relations with few moves.

Defined cases: a null or unknown target is refused like any illegal one; equal
commands are applied one after the other; a key without commands has no row; a
state may have an edge to itself, which counts as a move; a key whose given state
is unknown to the relation keeps it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lifecycle import invalid_message
from tidemark.session import cut_lineage

STRETCH = 256


class StateMaps:
    """State maps as columns: an array of (to, moves), one for each state."""

    def __init__(self, relation: Mapping[str, Sequence[str]], start: str):
        self.states = sorted({start, *relation, *(t for ts in relation.values() for t in ts)})
        n = len(self.states)
        legal = [s in relation and t in relation[s] for t in self.states for s in self.states]
        self.n = n
        self.legal = F.array(*map(F.lit, legal))
        self.names = F.array(*map(F.lit, self.states))

    def code(self, state: Column) -> Column:
        """The state's number; -1 for one that the relation does not know."""
        return F.coalesce(F.array_position(self.names, state), F.lit(0)).cast("int") - 1

    def name(self, code: Column) -> Column:
        return F.get(self.names, code)

    def allowed(self, code: Column, target: Column) -> Column:
        known = (code >= 0) & (target >= 0)
        return F.coalesce(known & F.get(self.legal, F.greatest(target, F.lit(0)) * self.n + code), F.lit(False))

    def identity(self) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("to"), F.lit(0).cast("long").alias("moves")) for i in range(self.n)])

    def after(self, to: Column, moves: Column, target: Column) -> Column:
        """(to, moves) after one more command."""
        ok = self.allowed(to, target)
        return F.struct(F.when(ok, target).otherwise(to).alias("to"), (moves + ok.cast("long")).alias("moves"))

    def folded(self, targets: Column) -> Column:
        return F.aggregate(targets, self.identity(), lambda m, t: F.transform(m, lambda x: self.after(x["to"], x["moves"], t)))

    def through(self, to: Column, moves: Column, m: Column) -> Column:
        """(to, moves) after a whole map."""
        x = F.get(m, to)
        return F.struct(F.coalesce(x["to"], to).alias("to"), (moves + F.coalesce(x["moves"], F.lit(0))).alias("moves"))

    def composed(self, maps: Column) -> Column:
        return F.aggregate(maps, self.identity(), lambda m, b: F.transform(m, lambda x: self.through(x["to"], x["moves"], b)))


def _placed(commands: DataFrame, order: list[str]) -> DataFrame:
    """``commands`` in order, with a dense ``place``: written once, then numbered
    by the offsets of the sorted partitions."""
    raw = commands.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    raw = cut_lineage(raw, "prefix-sorted")
    part = F.shiftright("_at", 33)
    counts = sorted((r.p, r["count"]) for r in raw.groupBy(part.alias("p")).count().collect())  # one row a partition
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    known = raw.sparkSession.createDataFrame(offsets or [(0, 0)], "_part long, _offset long")
    numbered = raw.withColumn("_p", part).join(F.broadcast(known), F.col("_p") == F.col("_part"))
    return numbered.withColumn("place", F.col("_offset") + F.col("_at") - F.shiftleft("_p", 33)).drop("_at", "_p", "_part", "_offset")


def prefix_outcomes(commands: DataFrame, relation: Mapping[str, Sequence[str]], start: str,
                    initial: DataFrame | None = None, stretch: int = STRETCH) -> DataFrame:
    """Every command (``key, ts, seq, target``) with ``state_before``, ``applied``,
    ``moves_before`` (in this fold) and ``rejection``, for any relation.

    ``initial``: optional ``key, status``; other keys begin at ``start``.
    """
    maps = StateMaps(relation, start)
    rows = _placed(commands.select("key", "ts", "seq", "target"), ["key", "ts", "seq", "target"])

    def lists(items: DataFrame, number: str, fields: list) -> DataFrame:
        group = F.floor(F.col(number) / stretch).cast("long").alias("group")
        return items.groupBy("key", group).agg(F.sort_array(F.collect_list(F.struct(F.col(number).alias("i"), *fields))).alias("items"))

    coded = rows.withColumn("t", maps.code(F.col("target")))
    level = lists(coded, "place", ["t", "ts", "seq", "target"])
    level = cut_lineage(level.withColumn("map", maps.folded(F.transform("items", lambda x: x["t"]))), "prefix-0")
    levels = [level]
    while levels[-1].groupBy("key").count().where("count > 1").limit(1).count():
        up = lists(levels[-1], "group", ["map"])
        up = up.withColumn("map", maps.composed(F.transform("items", lambda x: x["map"])))
        levels.append(cut_lineage(up, f"prefix-{len(levels)}"))

    zero = F.lit(0).cast("long")
    met = levels[-1].select("key", "group")
    if initial is None:
        met = met.select("key", "group", F.struct(maps.code(F.lit(start)).alias("to"), zero.alias("moves")).alias("met"), F.lit(start).alias("given"))
    else:
        given = initial.select(F.col("key").alias("of"), "status", F.lit(True).alias("found"))
        status = F.when(F.col("found"), F.col("status")).otherwise(F.lit(start))
        met = met.join(given, F.col("key").eqNullSafe(F.col("of")), "left").select(
            "key", "group", F.struct(maps.code(status).alias("to"), zero.alias("moves")).alias("met"), status.alias("given"))

    def entered(held: DataFrame, met: DataFrame) -> DataFrame:
        told = met.select(F.col("key").alias("of"), F.col("group").alias("at"), "met", "given")
        return held.join(told, F.col("key").eqNullSafe(F.col("of")) & (F.col("group") == F.col("at")))

    def met_by(step) -> Column:
        """The (to, moves) that every item of a list meets: at most ``stretch`` of them."""
        first = F.struct(F.col("met").alias("now"), F.array().cast("array<struct<to:int,moves:bigint>>").alias("seen"))
        run = F.aggregate("items", first, lambda a, x: F.struct(
            step(a["now"], x).alias("now"), F.concat(a["seen"], F.array(a["now"])).alias("seen")))
        return run["seen"]

    for held in reversed(levels[1:]):
        seen = met_by(lambda now, x: maps.through(now["to"], now["moves"], x["map"]))
        below = entered(held, met).select("key", "given", F.explode(F.arrays_zip(F.col("items.i").alias("i"), seen.alias("met"))).alias("x"))
        met = below.select("key", F.col("x.i").alias("group"), F.col("x.met").alias("met"), "given")
    seen = met_by(lambda now, x: maps.after(now["to"], now["moves"], x["t"]))
    out = entered(levels[0], met).select("key", "given", F.explode(F.arrays_zip(F.col("items").alias("c"), seen.alias("met"))).alias("x"))
    code, target = F.col("x.met.to"), F.col("x.c.target")
    before = F.coalesce(maps.name(code), F.col("given"))  # a state unknown to the relation never moves
    applied = maps.allowed(code, F.col("x.c.t"))
    return out.select("key", F.col("x.c.ts").alias("ts"), F.col("x.c.seq").alias("seq"), target.alias("target"), before.alias("state_before"),
                      applied.alias("applied"), F.col("x.met.moves").alias("moves_before"),
                      F.when(~applied, invalid_message(before, target)).alias("rejection"))


def prefix_state(outcomes: DataFrame) -> DataFrame:
    """(key, status, moves) after all commands: the last one of each key, by a partial maximum."""
    order = F.struct("ts", "seq", "moves_before")
    last = outcomes.groupBy("key").agg(F.max_by(F.struct("state_before", "target", "applied", "moves_before"), order).alias("l"))
    return last.select("key", F.when(F.col("l.applied"), F.col("l.target")).otherwise(F.col("l.state_before")).alias("status"),
                       (F.col("l.moves_before") + F.col("l.applied").cast("long")).alias("moves"))
