"""State-relation checks and the ordered command fold, set-based.

The fold applies commands ``(key, ts, seq, target)`` in ``(ts, seq)`` order:
a command whose target is a legal successor of the current state moves the
state; an illegal one is rejected and leaves it unchanged.

For an acyclic relation every key moves at most ``depth`` times (6 for the
request relation), so the fold is ``depth`` rounds of

    next move = min over commands after the current position whose target
                is a legal successor of the current state

``min`` is associative and commutative, so each round is a hash aggregate
with map-side partial aggregation: a key holding a third of all commands
costs one partial row per map task, never one task holding the whole group.
A relation with a cycle has no such bound and is refused (``move_bound``).
Each round only considers targets that can occur at that step, a constant
filter Catalyst pushes below the join, and only keys that moved in the
previous round (a key that did not move cannot move later), so after round 1
the other join side is the previous round's small table of movers. The join of commands with the
one-row-per-key state is a shuffle join that AQE splits when one key skews
a partition (or turns into a broadcast when the measured state is small).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans import policy as P
from tidemark.session import cut_lineage

EDGE_SEP = "\u0001"


def edge_set(relation: Mapping[str, Sequence[str]]) -> Column:
    return F.array(*[F.lit(f"{s}{EDGE_SEP}{t}") for s, ts in relation.items() for t in ts])


def legal_expr(src: Column, dst: Column, relation: Mapping[str, Sequence[str]]) -> Column:
    """J2 as a column: is ``src -> dst`` an edge of the relation (never NULL)."""
    return F.coalesce(
        F.array_contains(edge_set(relation), F.concat(src, F.lit(EDGE_SEP), dst)), F.lit(False)
    )


def invalid_message(src: Column, dst: Column) -> Column:
    return F.concat(F.lit("Invalid registration transition: "), F.coalesce(src, F.lit("None")),
                    F.lit(" -> "), F.coalesce(dst, F.lit("None")))


def check_transitions(df: DataFrame, from_col: str = "from_status", to_col: str = "to_status",
                      relation: Mapping[str, Sequence[str]] = P.REQUEST_TRANSITIONS) -> DataFrame:
    """J2 in bulk: ``legal`` flag and ``transition_error`` (NULL when legal)."""
    legal = legal_expr(F.col(from_col), F.col(to_col), relation)
    return df.withColumn("legal", legal).withColumn(
        "transition_error", F.when(~legal, invalid_message(F.col(from_col), F.col(to_col))))


def move_bound(relation: Mapping[str, Sequence[str]], starts: set[str]) -> int:
    """Moves a key can make at most from any of ``starts``. A relation with a
    cycle has no bound: a batch fold would need a job for each move of its
    busiest key, so it is refused."""
    depths = [P.relation_depth(relation, s) for s in starts]
    if any(d is None for d in depths):
        raise ValueError("the relation has a cycle, so a key's moves have no bound: "
                         "use the state-store engine of tidemark.streaming.lifecycle_state")
    return max(depths)


def _targets_by_step(relation: Mapping[str, Sequence[str]], starts: set[str], rounds: int) -> list[set[str]]:
    """Targets that can be reached by exactly ``r`` moves, for r = 1..rounds."""
    frontier, out = starts, []
    for _ in range(rounds):
        nxt = {t for s in frontier for t in relation.get(s, ())}
        out.append(nxt)
        frontier = nxt
    return out


def fold_transitions(
    commands: DataFrame,
    relation: Mapping[str, Sequence[str]] = P.REQUEST_TRANSITIONS,
    start: str = P.NEW,
    initial: DataFrame | None = None,
    key: str = "key",
    materialize_commands: bool = False,
    add_missing_keys: bool = True,
    write_initial: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Replay ordered commands per key; returns ``(state, moves)``.

    ``commands``: ``key, ts, seq, target`` (+ any payload columns, carried
    onto the moves). ``initial``: optional ``key, status, last_ts, last_seq``
    (current states); keys absent from it start at ``start`` with no
    position, unless ``add_missing_keys`` is false: then their commands are
    left unapplied (no state to move) and the distinct/anti join that finds
    them is skipped. ``write_initial`` false: ``initial`` is a stored table,
    read where it is instead of being written once more.

    ``state``: ``key, status, last_ts, last_seq, moves`` per key.
    ``moves``: one row per applied command: ``key, step, ts, seq,
    from_status, to_status`` + payload; ``step`` counts from 1 per fold.
    """
    # with given starting states: the longest path from any state
    starts = {start} if initial is None else set(relation) | {start}
    rounds = move_bound(relation, starts)
    payload = [c for c in commands.columns if c not in (key, "ts", "seq", "target")]

    cmds = commands.select(F.col(key).alias("key"), "ts", "seq", "target", *payload)
    if materialize_commands:
        # a costly derived command table is written once instead of being
        # re-derived by every round
        cmds = cut_lineage(cmds, "commands")
    if initial is None:
        # every key starts at ``start`` with no position; only the keys that
        # end with no move at all need this (for the final state)
        state0 = cmds.select("key").distinct().select(
            "key", F.lit(start).alias("status"),
            F.lit(None).cast(cmds.schema["ts"].dataType).alias("last_ts"),
            F.lit(None).cast(cmds.schema["seq"].dataType).alias("last_seq"))
    else:
        init = initial.select(F.col(key).alias("key"), "status", "last_ts", "last_seq")
        if add_missing_keys:
            missing = cmds.select("key").distinct().join(
                init.select("key"), "key", "left_anti").select(
                "key", F.lit(start).alias("status"),
                F.lit(None).cast(init.schema["last_ts"].dataType).alias("last_ts"),
                F.lit(None).cast(init.schema["last_seq"].dataType).alias("last_seq"))
            init = init.unionByName(missing)
        # one row per key; written once, read by round 1 and the final state
        state0 = cut_lineage(init, "state0") if write_initial else init

    terminal = sorted(set([s for s in P.STATES if not relation.get(s)] + [
        t for ts in relation.values() for t in ts if not relation.get(t)]))
    step_targets = _targets_by_step(relation, starts, rounds)
    moves: list[DataFrame] = []

    def current() -> DataFrame:
        """State after all moves: initial state + latest written move per key."""
        base = state0.withColumn("moves", F.lit(0).cast("bigint"))
        if not moves:
            return base
        done = moves[0]
        for m in moves[1:]:
            done = done.unionByName(m)
        last = done.groupBy("key").agg(
            F.max_by(F.struct("to_status", "ts", "seq"), F.col("step")).alias("l"),
            F.count(F.lit(1)).cast("bigint").alias("n"))
        return state0.join(last, "key", "left").select(
            "key",
            F.coalesce(F.col("l.to_status"), F.col("status")).alias("status"),
            F.coalesce(F.col("l.ts"), F.col("last_ts")).alias("last_ts"),
            F.coalesce(F.col("l.seq"), F.col("last_seq")).alias("last_seq"),
            F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("moves"),
        )

    # Keys that may still move. A key that did not move in a round cannot
    # move in a later one (same state, same position, and that round already
    # found no legal command after it), so after round 1 the active keys are
    # exactly the non-terminal keys the previous round moved: a small table.
    active = None if initial is None else state0.where(~F.col("status").isin(terminal)).select(
        "key", F.col("status").alias("cur"), "last_ts", "last_seq")
    for r in range(1, rounds + 1):
        cand = cmds.where(F.col("target").isin(sorted(step_targets[r - 1])))
        if active is None:
            # round 1 from ``start`` with no position: no join needed
            cand = cand.withColumn("cur", F.lit(start)).where(
                legal_expr(F.col("cur"), F.col("target"), relation))
        else:
            after = F.col("last_ts").isNull() | (
                F.struct("ts", "seq") > F.struct(F.col("last_ts"), F.col("last_seq")))
            cand = cand.join(active, "key").where(
                after & legal_expr(F.col("cur"), F.col("target"), relation))
        best = cand.groupBy("key").agg(
            F.min(F.struct("ts", "seq", "target", "cur", *payload)).alias("m"))
        step = best.select(
            "key", F.lit(r).cast("bigint").alias("step"),
            F.col("m.ts").alias("ts"), F.col("m.seq").alias("seq"),
            F.col("m.cur").alias("from_status"), F.col("m.target").alias("to_status"),
            *[F.col(f"m.{c}").alias(c) for c in payload],
        )
        step = cut_lineage(step, f"moves-{r}", "zstd")
        moves.append(step)
        active = step.where(~F.col("to_status").isin(terminal)).select(
            "key", F.col("to_status").alias("cur"), F.col("ts").alias("last_ts"),
            F.col("seq").alias("last_seq"))
    state = current()
    if moves:
        all_moves = moves[0]
        for m in moves[1:]:
            all_moves = all_moves.unionByName(m)
    else:
        all_moves = cmds.limit(0).select(
            "key", F.lit(0).cast("bigint").alias("step"), "ts", "seq",
            F.lit(None).cast("string").alias("from_status"), F.col("target").alias("to_status"),
            *payload)
    return state, all_moves


def command_outcomes(
    commands: DataFrame,
    moves: DataFrame,
    start: str = P.NEW,
    key: str = "key",
    relation: Mapping[str, Sequence[str]] = P.REQUEST_TRANSITIONS,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Every command with the state it met and whether it applied.

    Per key the applied moves are few (at most the relation depth, a proven
    bound), so they travel as one row per key with a column per step; each
    command picks the last move before it. The join of commands with that
    one-row-per-key table is left to AQE, which splits a hot key's partition.
    A command applied if a move has its whole position and target: ``seq``
    alone may repeat at another ``ts``. The same columns tell that, so the
    commands are shuffled once.
    """
    cmd = commands.select(F.col(key).alias("key"), "ts", "seq", "target")
    bound = move_bound(relation, {start} if initial is None else set(relation) | {start})
    pos = F.struct(F.col("ts"), F.col("seq"))
    # at most ``bound`` moves per key, numbered by step at increasing
    # positions: one column per step, and the state a command met is the
    # highest step before it (plain CASE expressions, whole-stage codegen)
    hist = moves.groupBy("key").agg(*[
        F.max(F.when(F.col("step") == r, F.struct("ts", "seq", "to_status"))).alias(f"_m{r}")
        for r in range(1, bound + 1)])
    seen = [F.when(F.col(f"_m{r}").isNotNull()
                   & (F.struct(F.col(f"_m{r}.ts"), F.col(f"_m{r}.seq")) < pos),
                   F.col(f"_m{r}.to_status")) for r in range(bound, 0, -1)]
    met = cmd.join(hist, "key", "left")
    if initial is not None:
        met = met.join(initial.select(F.col(key).alias("key"), F.col("status").alias("init")), "key", "left")
    else:
        met = met.withColumn("init", F.lit(None).cast("string"))
    state_at = F.coalesce(*seen, F.col("init"), F.lit(start))
    own = [(F.col(f"_m{r}.to_status") == F.col("target")) & (F.col(f"_m{r}.ts") == F.col("ts"))
           & (F.col(f"_m{r}.seq") == F.col("seq")) for r in range(1, bound + 1)]
    applied = F.coalesce(*[F.when(o, F.lit(True)) for o in own], F.lit(False))
    return met.select(
        "key", "ts", "seq", "target",
        state_at.alias("state_before"),
        applied.alias("applied"),
        F.when(~applied, invalid_message(state_at, F.col("target"))).alias("rejection"),
    )
