"""Exact top-k inner products by no-random-access aggregation.

Vectors become whole numbers, ``floor(scale * x)`` per component. Candidates
are cut by hash of their row into blocks, queries into blocks of their own, and
every query block meets every candidate block once (a stated query set against
all rows, in blocks). A block keeps one sorted list per component. The lists
are read in step, a stretch at a time, from the large end for a query's
positive components and from the small end for its negative ones:

- a vector has a lower bound (what was read, plus each unread list's worst
  value) and an upper bound (plus each unread list's next value); one that no
  list has shown yet is bounded by the worst and the next values alone;
- a query stops reading when all but a few vectors have an upper bound below
  the k-th lower bound;
- the survivors' scores are then resolved from their remaining components.

What was read to a depth is the same for all queries, but for the end read
from; so the bounds of many queries are one matrix product a depth.

Each pair of blocks gives at most k rows per query. Those are merged by a rank
per query whose limit Spark pushes below the shuffle.

Scale: candidates are shuffled once per query block and queries once per
candidate block, in blocks of bounded size; nothing is broadcast and nothing
but the two row counts comes to the driver. Work is the product of queries and
rows, as an exact answer with weak bounds needs.

Defined cases: rows take no part if the id or the vector is null or a
component is null or not finite; a shorter vector's missing components count
0; rows equal in id and vector count once; rows that repeat an id with another
vector each stand for themselves, as candidates and as queries (with ranks of
their own), and a query leaves out its own row only; fewer than k candidates:
all are returned; ties go to the smaller id; scores are exact while they and
their bounds stay within 2**53; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import written

SCALE = 1024
K = 10
BLOCK = 4096  # candidates
QUERIES = 1024  # per block
TOGETHER = 128  # queries of a block whose bounds are kept at once
STRETCH = 64  # entries read from each list at first; doubles


def whole_vectors(rows: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, id, v) of the rows that take part, one per id and vector; ``row`` tells them apart."""
    vec = F.col(vec_col)
    fit = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = rows.where(F.col(id_col).isNotNull() & vec.isNotNull() & F.coalesce(fit, F.lit(False)))
    out = out.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).distinct()
    v = F.transform("vec", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return out.select(F.monotonically_increasing_id().alias("row"), "id", v.cast("array<bigint>").alias("v"))


class Block:
    """Candidates with one sorted list per component."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.rows, self.ids, self.x = rows[order], ids[order], x[order]
        self.rank = np.argsort(np.argsort(self.x, axis=0, kind="stable"), axis=0, kind="stable")  # place in the component's ascending list
        self.sorted = np.sort(self.x, axis=0).astype(float)

    def read(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """What is known once every list is read ``at`` entries deep: the least
        and the most that each vector can add per component, first for positive
        weights (lists read from the large end), then for negative ones."""
        n = len(self.ids)
        down, up = self.rank >= n - at, self.rank < at
        after = min(at, n - 1)
        worst = [np.where(down, self.x, self.sorted[0]), np.where(up, self.x, self.sorted[-1])]
        best = [np.where(down, self.x, self.sorted[n - 1 - after]), np.where(up, self.x, self.sorted[after])]
        return np.concatenate(worst, axis=1), np.concatenate(best, axis=1)

    def top(self, q_rows: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places, scores) of the k best for each row of ``q``, without the query's own row."""
        n = len(self.ids)
        weights = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(float)
        by_row = np.argsort(self.rows)
        own = by_row[np.minimum(np.searchsorted(self.rows, q_rows, sorter=by_row), n - 1)]
        own = np.where(self.rows[own] == q_rows, own, -1)
        found: list = [None] * len(q)
        reading, at, stretch = np.arange(len(q)), 0, STRETCH
        while len(reading):
            at, stretch = min(n, at + stretch), 2 * stretch
            worst, best = self.read(at)
            on = []
            for some in np.array_split(reading, -(-len(reading) // TOGETHER)):
                low, high = weights[some] @ worst.T, weights[some] @ best.T
                itself = np.flatnonzero(own[some] >= 0)
                low[itself, own[some][itself]] = high[itself, own[some][itself]] = -np.inf
                floor = np.partition(low, n - k, axis=1)[:, n - k, None] if n >= k else -np.inf
                # a vector that can still tie stays: ties go to the smaller id
                alive = (high >= floor) & (high > -np.inf)
                done = (alive.sum(axis=1) <= max(4 * k, n // 64)) | (at == n)
                on.append(some[~done])
                for row in np.flatnonzero(done):
                    places, i = np.flatnonzero(alive[row]), some[row]
                    scores = self.x[places] @ q[i]  # resolves the unread components of the survivors
                    order = np.lexsort((self.ids[places], -scores))[:k]
                    found[i] = places[order], scores[order]
            reading = np.concatenate(on)
        return found


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def top_k(rows: DataFrame, queries: Column, *, k: int = K, block: int = BLOCK, query_block: int = QUERIES,
          id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows for every row that ``queries`` (a condition on ``id``) names."""
    all_rows = written(whole_vectors(rows, id_col=id_col, vec_col=vec_col, scale=scale), "topk-vectors")
    asked = all_rows.where(queries)
    n, n_queries = all_rows.count(), asked.count()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // query_block))

    def place(salt: str, m: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), F.col("row")), F.lit(m)).cast("int")

    def every(m: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(m - 1)))

    left = asked.select("row", "id", "v", place("q", query_blocks).alias("qb"), every(blocks).alias("cb"))
    right = all_rows.select("row", "id", "v", every(query_blocks).alias("qb"), place("c", blocks).alias("cb"))

    def pair(qs: pa.Table, cs: pa.Table) -> pa.Table:
        qs, cs = qs.combine_chunks(), cs.combine_chunks()
        out: list[tuple] = []
        if qs.num_rows and cs.num_rows:
            cols = [t.column(c).combine_chunks() for t in (qs, cs) for c in ("row", "id", "v")]
            width = max(int(np.diff(c.offsets.to_numpy()).max()) for c in cols[2::3])
            q_rows, q = cols[0].to_numpy(), _matrix(cols[2], width)
            cands = Block(cols[3].to_numpy(), cols[4].to_numpy(), _matrix(cols[5], width))
            for row, i, (places, scores) in zip(q_rows.tolist(), cols[1].to_pylist(), cands.top(q_rows, q, k), strict=True):
                out += zip([row] * len(places), [i] * len(places), cands.ids[places].tolist(), scores.tolist(), strict=True)
        columns = zip(*out, strict=True) if out else ((),) * 4
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("query_row", "query_id", "id", "score"), columns, strict=True)})

    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(pair, "query_row long, query_id long, id long, score long")
    order = W.partitionBy("query_row").orderBy(F.desc("score"), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
