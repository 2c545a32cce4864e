"""Hard negatives by Four-Russians scoring of whole-number vectors.

Vectors become whole numbers, ``floor(scale * x)`` per component. A candidate
is packed once: dimensions go in groups of eight, and each bit of the group's
two's-complement components gives one byte (a bit plane). An anchor has, for
each group, a table of the sums of all 256 subsets of its eight components. The
score of a pair is then

    sum over planes of 2**plane * sum over groups of table[group][byte]

(the highest plane counts negative): lookups by the candidate's bytes, shifted
and added. The result is the full inner product, exactly.

1. Positives. Anchors meet the rows of their own label: labels are cut by hash
   into blocks by their row counts, so a hot label is many blocks; each pair of
   blocks gives an anchor's best few and a rank per anchor merges them.
2. Negatives. Each positive gives a band of allowed scores. Anchors with their
   bands meet all rows, in blocks (a stated query set against all rows), and
   each pair of blocks gives the best few rows of another label in each band; a
   rank per anchor and positive merges them. Ranks have their limit pushed below
   the shuffle.

Scale: rows are copied once per block of ``QUERIES`` anchors, anchors once per
block of ``BLOCK`` rows; a task holds one block of each and nothing is broadcast.
The driver sees four numbers (rows, anchors, the widest vector, the largest
component). Work is anchors times rows, as the exact answer needs.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a null id may be a positive or a negative (last of its
ties) and is no anchor; a shorter vector's missing components count 0; rows that
repeat an id, or are alike in everything, each stand for themselves; ties go to
the smaller id; scores must fit in 64 bits; an anchor without a positive, or a
positive without a row in its band, gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import written

GROUP = 8  # dimensions of a subset-sum table, one byte of a bit plane
BLOCK = 4096  # rows
QUERIES = 1024  # anchors of a block
TOGETHER = 64  # anchors whose tables and scores are kept at once
_LAST = np.iinfo(np.int64).max  # stands for a null id in ties


def whole_rows(rows: DataFrame, *, scale: int, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """(row, id, label, v) of the rows that take part."""
    vec = F.col(vec_col)
    fit = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = rows.where(F.col(label_col).isNotNull() & vec.isNotNull() & F.coalesce(fit, F.lit(False)))
    v = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return out.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("v")
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of one width, zero where a list is shorter."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """Bit-plane bytes [row, group, plane] of two's-complement components."""
    n, width = x.shape
    groups = -(-width // GROUP)
    full = np.zeros((n, groups * GROUP), np.int64)
    full[:, :width] = x
    bits = (full.reshape(n, groups, 1, GROUP) >> np.arange(planes)[:, None]) & 1
    return (bits << np.arange(GROUP)).sum(axis=3).astype(np.uint8)


def subset_sums(a: np.ndarray, kind: type) -> np.ndarray:
    """Tables [group, subset, anchor]: the sums of all subsets of each group's
    components, each table doubled once per component."""
    n, width = a.shape
    groups = -(-width // GROUP)
    full = np.zeros((n, groups * GROUP), kind)
    full[:, :width] = a
    parts = full.T.reshape(groups, GROUP, n)
    out = np.zeros((groups, 1, n), kind)
    for i in range(GROUP):
        out = np.concatenate([out, out + parts[:, i : i + 1]], axis=1)
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products [row, anchor] by shifted sums of looked-up subset sums."""
    total = None
    for b in range(planes.shape[2] - 1, -1, -1):
        plane = tables[0][planes[:, 0, b]]
        for g in range(1, len(tables)):
            plane += tables[g][planes[:, g, b]]
        if total is None:
            total = -plane  # the sign plane
        else:
            total += total
            total += plane
    return total


class Block:
    """Packed rows of one block, with what decides their order and labels."""

    def __init__(self, t: pa.Table, labels: dict, width: int, planes: int):
        col = {c: t.column(c).combine_chunks() for c in t.column_names}
        self.rows = col["row"].to_numpy()
        self.known = col["id"].is_valid().to_numpy(zero_copy_only=False)
        self.ids = col["id"].fill_null(_LAST).to_numpy()
        self.labels = codes(col["label"], labels)
        self.packed = np.frombuffer(b"".join(col["packed"].to_pylist()), np.uint8).reshape(len(self.rows), -1, planes)

    def best(self, own: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` first of ``places`` by score, then id."""
        if len(places) > most:
            s = own[places]
            places = places[s >= np.partition(s, len(s) - most)[len(s) - most]]
        return places[np.lexsort((self.ids[places], ~self.known[places], -own[places]))][:most]


def codes(column: pa.Array, known: dict) -> np.ndarray:
    return np.array([known.setdefault(x, len(known)) for x in column.to_pylist()], np.int64)


def hard_negatives(rows: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 3, band: tuple[int, int] = (50, 95), scale: int = 256,
                   block: int = BLOCK, query_block: int = QUERIES, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    for every row that ``anchors`` (a condition on ``id``) names: the best
    ``negatives`` rows of another label whose score is within ``band`` percent
    of the score of each of the anchor's ``positives`` best rows of its label."""
    table = written(whole_rows(rows, scale=scale, id_col=id_col, label_col=label_col, vec_col=vec_col), "negatives-rows")
    size = F.when(F.size("v") > 0, F.greatest(F.array_max("v"), -F.array_min("v") - 1)).otherwise(0)
    n, n_anchors, width, largest = table.agg(
        F.count(F.lit(1)), F.count_if(F.coalesce(anchors, F.lit(False))), F.max(F.size("v")), F.max(size)).first()
    width, planes = max(1, width or 0), max(1, int(largest or 0).bit_length()) + 1
    # the largest sum of a plane and of a score decide the lookups' width
    kind = np.int32 if width << (2 * planes) < 1 << 31 else np.int64
    lists = -(-width // GROUP)

    def packed(batches):
        for batch in batches:
            x = pack(matrix(batch.column(3), width), planes)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([r.tobytes() for r in x], pa.binary())], ["row", "id", "label", "packed"])

    label_type = table.schema["label"].dataType.simpleString()
    full = written(table.mapInArrow(packed, f"row long, id long, label {label_type}, packed binary"), "negatives-packed")
    asked = table.where(anchors)

    def chunk(salt: str, m: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), F.col("row")), m).cast("int")

    def every(m: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), m - 1))

    def chunks(rows_: Column, most: int) -> Column:
        return F.greatest(F.ceil(rows_ / most), F.lit(1)).cast("int")

    def searched(qs: pa.Table, answer):
        """``answer(anchor row, its scores)`` for every anchor of a block, tables made for a few at a time."""
        vectors = matrix(qs.column("v").combine_chunks(), width)

        def over(c: Block):
            for at in range(0, len(vectors), TOGETHER):
                s = scores(subset_sums(vectors[at : at + TOGETHER], kind), c.packed).T
                for i, own in enumerate(s):
                    answer(at + i, np.ascontiguousarray(own))

        return over

    # 1: an anchor's best rows of its own label; blocks per label by its counts
    per_label = table.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(anchors, F.lit(False))).alias("n_asked"))
    per_label = written(per_label.where("n_asked > 0").select(
        F.col("label").alias("of"), chunks(F.col("n_rows"), block).alias("cbs"), chunks(F.col("n_asked"), query_block).alias("qbs")), "negatives-labels")
    q1 = asked.join(per_label, F.col("label") == F.col("of")).select(
        "row", "id", "v", "label", chunk("q", F.col("qbs")).alias("qb"), every(F.col("cbs")).alias("cb"))
    c1 = full.join(per_label, F.col("label") == F.col("of")).select(
        "row", "id", "label", "packed", chunk("c", F.col("cbs")).alias("cb"), every(F.col("qbs")).alias("qb"))

    def same_label(qs: pa.Table, cs: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if qs.num_rows and cs.num_rows:
            c = Block(cs, {}, width, planes)
            q_rows, q_ids = qs.column("row").to_pylist(), qs.column("id").to_pylist()

            def answer(i, own):
                for p in c.best(own, np.flatnonzero(c.rows != q_rows[i]), positives):
                    out.append((q_rows[i], q_ids[i], int(c.rows[p]), int(c.ids[p]) if c.known[p] else None, int(own[p])))

            searched(qs, answer)(c)
        columns = zip(*out, strict=True) if out else ((),) * 5
        names = ("anchor", "anchor_id", "positive", "positive_id", "positive_score")
        return pa.table({name: pa.array(col, pa.int64()) for name, col in zip(names, columns, strict=True)})

    # keyed by the label's digest: one key for any type of label
    own1, own2 = (d.withColumn("of", F.xxhash64("label")) for d in (q1, c1))
    best = own1.groupBy("of", "qb", "cb").cogroup(own2.groupBy("of", "qb", "cb")).applyInArrow(
        same_label, "anchor long, anchor_id long, positive long, positive_id long, positive_score long")
    order = W.partitionBy("anchor").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), F.asc("positive"))
    chosen = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    chosen = written(chosen, "negatives-positives")

    # 2: the best rows of other labels in each positive's band
    bands = chosen.groupBy("anchor").agg(F.collect_list(F.struct("place", "positive_score")).alias("bands"))  # at most ``positives``
    bands = bands.withColumnRenamed("anchor", "of")
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_anchors // query_block))
    q2 = asked.join(bands, F.col("row") == F.col("of")).select(
        "row", "v", "label", "bands", chunk("q", F.lit(query_blocks)).alias("qb"), every(F.lit(blocks)).alias("cb"))
    c2 = full.select("row", "id", "label", "packed", chunk("c", F.lit(blocks)).alias("cb"), every(F.lit(query_blocks)).alias("qb"))

    def other_label(qs: pa.Table, cs: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if qs.num_rows and cs.num_rows:
            known: dict = {}
            c = Block(cs, known, width, planes)
            q_rows, q_bands, q_labels = qs.column("row").to_pylist(), qs.column("bands").to_pylist(), codes(qs.column("label").combine_chunks(), known)

            def answer(i, own):
                found: dict[int, list] = {}
                other = c.labels != q_labels[i]
                for b in q_bands[i]:
                    s = b["positive_score"]
                    if s not in found:
                        least, most = -(-band[0] * s // 100), band[1] * s // 100
                        found[s] = c.best(own, np.flatnonzero(other & (own >= least) & (own <= most)), negatives).tolist()
                    out.extend((q_rows[i], b["place"], int(c.ids[p]) if c.known[p] else None, int(own[p])) for p in found[s])

            searched(qs, answer)(c)
        columns = zip(*out, strict=True) if out else ((),) * 4
        return pa.table({name: pa.array(col, pa.int64()) for name, col in zip(("of", "at", "negative_id", "negative_score"), columns, strict=True)})

    near = q2.groupBy("qb", "cb").cogroup(c2.groupBy("qb", "cb")).applyInArrow(other_label, "of long, at long, negative_id long, negative_score long")
    order = W.partitionBy("of", "at").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    joined = chosen.join(near, (F.col("anchor") == F.col("of")) & (F.col("place") == F.col("at")))
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
