"""Removal of repeated 200-byte strings by bucket-pointer refinement.

Every byte goes that is covered by a string of ``length`` bytes that also
starts anywhere else. Positions that could start such a string are kept in
buckets of equal text, which are refined by the text at later offsets until
they tell every position, without ever listing all positions:

0. Anchors. The least hash of the 8-grams in the first ``length - q + 1``
   places of a string picks one of its places by content alone, so equal
   strings pick the same place. About one position in 76 is an anchor; each
   stands for the consecutive strings that pick it.
1. Initial buckets: the ``q``-gram at the anchor. An anchor alone in its
   bucket starts no repeat and goes (partial aggregate, then an equi join).
2. Whole context: all text that any string of the anchor can reach. Where it
   is shared, all of it is marked. A bucket with one context is done. Of each
   other bucket one representative per context goes on (weight 2 if shared).
3. Cells: the anchor's strings by 32 starts. The text common to a cell's
   strings is the new bucket, all that they reach the new context; the step is
   the same again.
4. Single strings of the cells still open, by their own text.

Each level groups on bucket identifiers (hashes of 128 bits where they decide,
64 where a false meeting only costs work) and hands the survivors down. The
marks of a document are merged and cut out in one pass.

Scale: documents are written once, bucketed by row number, and each level's
positions join them there, so texts are shuffled once. Shuffles hold sampled
positions; a group of copies is one group with partial aggregation, and goes
on as one representative. Lists that are gathered belong to one document.

Defined cases: a null text is empty; a text shorter than ``length`` loses
nothing; matches never cross documents, overlaps count, strings are judged on
the input; repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tidemark.llm.common import written
from tidemark.session import lineage_root

LENGTH = 200
Q = 50
CELL = 32
BYTES_PER_BATCH = 8 << 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over every ``w`` neighbours: running values
    from both ends of blocks of ``w``."""
    n = len(x)
    blocks = -(-n // w)
    fill = np.full(blocks * w, x[-1], x.dtype)
    fill[:n] = x
    grid = fill.reshape(blocks, w)
    ahead = op.accumulate(grid, axis=1).ravel()
    back = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - w + 1], ahead[w - 1 : n])


def anchors(raw: bytes, length: int = LENGTH, q: int = Q) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): anchors and the starts of the strings that pick each."""
    n, w = len(raw), length - q + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 3
    h = np.ndarray((n - q + 1,), "<u8", buffer=raw, strides=(1,)) * _M1
    h ^= h >> np.uint64(29)
    h *= _M2
    h ^= h >> np.uint64(32)
    least = _sliding(h, w, np.minimum)  # of the string that starts at each place
    edge = np.zeros(w - 1, np.uint64)
    a = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), w, np.maximum) == h)
    v = h[a]
    first, last = np.maximum(a - w + 1, 0), np.minimum(a, n - length)
    for k in range(1, len(a)):
        near = a[k:] - a[:-k] < w
        if not near.any():
            break
        # the leftmost of equal places is picked
        j = np.flatnonzero(near & (v[:-k] <= v[k:]))
        first[j + k] = np.maximum(first[j + k], a[j] + 1)
        j = np.flatnonzero(near & (v[k:] < v[:-k]))
        last[j] = np.minimum(last[j], a[j + k] - w)
    live = first <= last
    return a[live], first[live], last[live]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


class Digests:
    """Rows of whole numbers with a 128-bit digest each."""

    def __init__(self, names: list[str]):
        self.names, self.rows, self.parts = names, [], []

    def add(self, row: tuple, text: bytes, seed: int = 0) -> None:
        self.rows.append(row)
        self.parts.append(xxh3_128_digest(text, seed))

    def batch(self) -> pa.RecordBatch:
        h = np.frombuffer(b"".join(self.parts), "<i8").reshape(-1, 2)
        cols = list(zip(*self.rows, strict=True)) or [()] * len(self.names)
        out = [pa.array(c, pa.int64()) for c in cols] + [pa.array(np.ascontiguousarray(h[:, i]), pa.int64()) for i in (0, 1)]
        self.rows, self.parts = [], []
        return pa.RecordBatch.from_arrays(out, [*self.names, "h1", "h2"])


def _each(work, names: list[str]):
    """A map over (row, text, list of structs) batches that collects digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = Digests(names)
            for row, text, items in zip(*batch.columns, strict=True):
                work(out, row.as_py(), text.as_py(), items.as_py())
                if len(out.rows) >= 200_000:
                    yield out.batch()
            yield out.batch()

    return run


def _bytes(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def _stored(docs: DataFrame, id_col: str) -> DataFrame:
    """(row, id, text) written once in the shared folder, bucketed by row number:
    joins on the row number leave the texts where they are."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), _bytes(F.col("text")).alias("text"))
    name = f"llm_suffix_{uuid.uuid4().hex}"
    rows.repartition(buckets, "row").write.format("parquet").option("compression", "zstd").option(
        "path", f"{lineage_root(spark)}/{name}"
    ).bucketBy(buckets, "row").saveAsTable(name)
    return spark.table(name)


def _with(stored: DataFrame, rows: DataFrame, fields: list[str]) -> DataFrame:
    """(row, text, items) of the documents that ``rows`` names, by the stored buckets."""
    lists = rows.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("items")).withColumnRenamed("row", "at")
    return stored.join(lists.hint("shuffle_hash"), stored["row"] == lists["at"]).select("row", "text", "items")


def _refined(items: DataFrame, where: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """One level: items (where..., bucket, h1, h2, w) -> the items of shared
    contexts, and a representative per context of the buckets with several."""
    groups = written(
        items.groupBy("bucket", "h1", "h2").agg(F.sum("w").alias("n"), F.min(F.struct(*where)).alias("rep")), f"suffix-{name}"
    )
    shared = groups.where("n > 1").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("bucket").alias("gb"))
    # members of weight 2 were marked a level up
    marked = items.where("w = 1").join(shared, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("bucket") == F.col("gb")))
    several = written(
        groups.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("bucket").alias("open")), f"suffix-{name}-open"
    )
    reps = groups.join(several, F.col("bucket") == F.col("open")).select("rep.*", F.least("n", F.lit(2)).alias("w"))
    return marked.select(*where), reps


def repeated(stored: DataFrame, length: int = LENGTH, q: int = Q, cell: int = CELL) -> DataFrame:
    """(row, start, end): ranges, which may overlap or pass the text's end, that
    cover exactly the repeated bytes."""

    def initial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(*batch.columns, strict=True):
                raw = text.as_py()
                places = anchors(raw, length, q)[0]
                if len(places):
                    buckets = [_signed(xxh3_64_intdigest(raw[a : a + q])) for a in places.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(places), row.as_py()), pa.int64()), pa.array(places, pa.int64()), pa.array(buckets, pa.int64())],
                        ["row", "off", "bucket"],
                    )

    def contexts(out: Digests, row: int, raw: bytes, items: list[dict]) -> None:
        for i in items:
            a, bucket = i["off"], i["bucket"]
            left = min(length - q, a)
            out.add((row, a, bucket), raw[a - left : a + length], left)

    def open_cells(raw: bytes, offs: set[int]):
        for a, first, last in zip(*(x.tolist() for x in anchors(raw, length, q)), strict=True):
            if a in offs:
                yield a, a - last, a - first

    def cells(out: Digests, row: int, raw: bytes, items: list[dict]) -> None:
        weight = {i["off"]: i["w"] for i in items}
        for a, least, most in open_cells(raw, set(weight)):
            for c in range(least // cell, most // cell + 1):
                top = a - c * cell  # the last start of the cell; the first is cell - 1 before
                start = max(0, top - cell + 1)
                # seeded by the cell: two anchors of one text may reach the same place
                bucket = _signed(xxh3_64_intdigest(raw[top : top - cell + 1 + length], c))
                out.add((row, a, c, weight[a], bucket), raw[start : top + length], c * cell + top - start)

    def singles(out: Digests, row: int, raw: bytes, items: list[dict]) -> None:
        weight = {(i["off"], i["cell"]): i["w"] for i in items}
        offs = {a for a, _ in weight}
        for a, least, most in open_cells(raw, offs):
            for c in range(least // cell, most // cell + 1):
                if (a, c) in weight:
                    for away in range(max(least, c * cell), min(most, c * cell + cell - 1) + 1):
                        out.add((row, a - away, weight[a, c]), raw[a - away : a - away + length])

    # found once: both the count of each bucket and the join below read the written anchors
    found = written(stored.select("row", "text").mapInArrow(initial, "row long, off long, bucket long"), "suffix-anchors")
    alone = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("bucket").alias("shared"))
    alone = written(alone, "suffix-q-grams")
    kept = found.join(alone, F.col("bucket") == F.col("shared")).select("row", "off", "bucket")
    names = ["row", "off", "bucket"]
    level = _with(stored, kept, ["off", "bucket"]).mapInArrow(_each(contexts, names), "row long, off long, bucket long, h1 long, h2 long")
    level = written(level, "suffix-contexts").withColumn("w", F.lit(1).cast("long"))
    marked, reps = _refined(level, ["row", "off"], "contexts-met")
    marks = marked.select("row", F.greatest(F.col("off") - (length - q), F.lit(0)).alias("start"), (F.col("off") + length).alias("end"))

    names = ["row", "off", "cell", "w", "bucket"]
    level = _with(stored, reps, ["off", "w"]).mapInArrow(_each(cells, names), "row long, off long, cell long, w long, bucket long, h1 long, h2 long")
    level = written(level, "suffix-cells")
    marked, reps = _refined(level, ["row", "off", "cell"], "cells-met")
    top = F.col("off") - F.col("cell") * cell
    marks = marks.unionByName(marked.select("row", F.greatest(top - cell + 1, F.lit(0)).alias("start"), (top + length).alias("end")))

    level = _with(stored, reps, ["off", "cell", "w"]).mapInArrow(_each(singles, ["row", "start", "w"]), "row long, start long, w long, h1 long, h2 long")
    level = written(level, "suffix-singles")
    same = written(level.groupBy("h1", "h2").agg(F.sum("w").alias("n")).where("n > 1").select(F.col("h1").alias("g1"), F.col("h2").alias("g2")), "suffix-singles-met")
    marked = level.where("w = 1").join(same, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    return marks.unionByName(marked.select("row", "start", (F.col("start") + length).alias("end")))


def merged(marks: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal runs of the marked bytes of a text."""
    out: list[list[int]] = []
    for start, end in sorted((m["start"], min(m["end"], size)) for m in marks):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, q: int = Q, cell: int = CELL, id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, spans, kept) of every document: the removed runs (byte
    offsets, ends exclusive) and the remaining bytes."""
    stored = _stored(docs, id_col)
    marks = repeated(stored, length, q, cell)
    lists = marks.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("marks")).withColumnRenamed("row", "at")
    rows = stored.join(lists.hint("shuffle_hash"), stored["row"] == lists["at"], "left").select("id", "text", "marks")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ids, sizes, spans, kept, total = at, [], [], [], 0
                while at < batch.num_rows and total < BYTES_PER_BATCH:
                    raw = batch.column(1)[at].as_py()
                    runs = merged(batch.column(2)[at].as_py() or [], len(raw))
                    edges = [0, *(e for r in runs for e in r), len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    spans.append([{"start": a, "end": b} for a, b in runs])
                    sizes.append(len(raw))
                    total += len(raw)
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(ids, at - ids), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                    ["id", "n_bytes", "spans", "kept"],
                )

    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
                        T.StructField("spans", T._parse_datatype_string("array<struct<start:bigint,end:bigint>>")), T.StructField("kept", T.BinaryType())])
    return rows.mapInArrow(cut, out).withColumnRenamed("id", id_col)
