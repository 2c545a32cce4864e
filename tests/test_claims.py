"""One request per opportunity: the same holders and conflicts for any split into batches."""

import datetime as dt
import os
import random

from tidemark.operators import claims

T0 = dt.datetime(2026, 1, 1)


def test_holders_do_not_depend_on_the_split(spark, tmp_dir):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "hot", "a", "b", "c", "d"]), f"r{i}", T0 + dt.timedelta(hours=rng.randint(0, 20))) for i in range(60)]
    broken = [(None, "n1", T0), ("a", None, T0), ("a", "n2", None)]
    best = {}
    for key, request, at in rows:
        best[key] = min(best.get(key, (at, request)), (at, request))
    want = {(k, r, t, best[k][1]) for k, r, t in rows if best[k][1] != r} | {(*b, None) for b in broken}
    for n, size in enumerate((63, 25)):
        root = os.path.join(tmp_dir, str(n))
        sent = rows + broken
        rng.shuffle(sent)
        parts = [sent[i : i + size] for i in range(0, len(sent), size)]
        for batch_id, part in enumerate([*parts, parts[0], []]):  # sent again, and nothing
            frame = spark.createDataFrame(part, claims.SCHEMA)
            claims.claim(frame, root, batch_id)
            if batch_id == 1:  # a replay
                claims.claim(frame, root, batch_id)
        got = {r.opportunity_id: (r.claimed_at, r.request_id) for r in claims.holders(spark, root).collect()}
        assert got == best
        lost = [tuple(r) for r in claims.conflicts(spark, root).collect()]
        assert len(lost) == len(set(lost)) and set(lost) == want
