"""The ordered fold as a parallel prefix, against sequential replay."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.operators import lifecycle, prefix_fold

CYCLE = {"NEW": ("a",), "a": ("b", "c"), "b": ("a", "b"), "c": ("NEW", "a"), "end": ()}


def replay(cmds, relation, start, initial=None):
    logs, out, last = defaultdict(list), [], {}
    for c in cmds:
        logs[c[0]].append(c)
    for key, log in logs.items():
        state, moves = (initial or {}).get(key, start), 0
        for _, ts, seq, target in sorted(log, key=lambda c: (c[1], c[2], c[3] or "")):
            ok = target in relation.get(state, ())
            out.append((key, ts, seq, target, state, ok, moves))
            state, moves = (target, moves + 1) if ok else (state, moves)
        last[key] = (state, moves)
    return out, last


def log(n, keys, seed):
    rng = random.Random(seed)
    key = [None, "hot", "hot", "hot", *(f"k{i}" for i in range(keys))]
    return [(rng.choice(key), rng.randint(0, 9), i, rng.choice(["a", "b", "c", "NEW", "end", "?", None])) for i in range(n)]


def test_prefix_fold_matches_sequential_replay(spark):
    cmds = log(1500, 40, 1)
    df = spark.createDataFrame(cmds, "key string, ts int, seq long, target string").repartition(3)
    want, last = replay(cmds, CYCLE, "NEW")
    out = prefix_fold.prefix_outcomes(df, CYCLE, "NEW", stretch=8)  # the hot key takes four levels
    rows = out.collect()
    assert sorted((tuple(r)[:7] for r in rows), key=str) == sorted(want, key=str)
    assert all((r.rejection is None) == r.applied for r in rows)
    assert {r.key: (r.status, r.moves) for r in prefix_fold.prefix_state(out).collect()} == last


def test_prefix_fold_from_given_states(spark):
    cmds = log(400, 10, 2)
    given = {"hot": "b", "k1": "end", "k2": "unknown", None: "c"}
    df = spark.createDataFrame(cmds, "key string, ts int, seq long, target string")
    initial = spark.createDataFrame(list(given.items()), "key string, status string")
    want, _ = replay(cmds, CYCLE, "NEW", given)
    got = prefix_fold.prefix_outcomes(df, CYCLE, "NEW", initial, stretch=16)
    assert sorted((tuple(r)[:7] for r in got.collect()), key=str) == sorted(want, key=str)
    assert prefix_fold.prefix_outcomes(df.limit(0), CYCLE, "NEW").collect() == []


def test_both_folds_agree_on_an_acyclic_relation(spark):
    relation = {"NEW": ("a",), "a": ("b", "c"), "b": ("c",)}
    cmds = [c for c in log(600, 30, 3) if c[0] is not None]
    df = spark.createDataFrame(cmds, "key string, ts int, seq long, target string")
    state, _ = lifecycle.fold_transitions(df.where(F.col("target").isNotNull()), relation, start="NEW")
    got = prefix_fold.prefix_state(prefix_fold.prefix_outcomes(df, relation, "NEW", stretch=32))
    assert {r.key: (r.status, r.moves) for r in state.collect()}.items() <= {r.key: (r.status, r.moves) for r in got.collect()}.items()
