"""SimHash near-duplicates by a tiled exact comparison of all fingerprints.

- Fingerprints come from a map over whole texts: 3-word shingles hashed with
  XXH64, bits by majority.
- Equal fingerprints meet in one partial aggregate (least document id), so a
  group of copies is one row, however large.
- Distinct fingerprints lie in cells by the population counts of their two
  halves. Within ``radius`` bits the two counts together differ by at most
  ``radius``, so only neighbouring cells are compared: all other tile pairs are
  skipped. Cells are cut by hash into tiles of about ``TILE`` fingerprints, so
  no cell is one task; every tile meets each tile of its neighbour cells, in
  numpy, by exclusive-or and bit counts.
- A tile pair keeps a forest of its links (no more than one link per
  fingerprint), not all pairs of a dense group; components are unchanged.
- Components of the links are found with star steps; each document then takes
  the component of its fingerprint by a plain equi join, which AQE splits at a
  hot fingerprint.

What the driver sees: the number of fingerprints per cell (at most 33 x 33).
The comparison is quadratic in distinct fingerprints, as the method is; the
cells leave about one pair in fifteen.

Defined cases: a null or empty text has no shingle: fingerprint zero, linked
like any other; fewer words than a shingle: the whole sequence is one; null
ids take no part in the least id (a component of null ids only has a null id);
repeated rows each give a row; empty input gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tidemark.llm.common import written
from tidemark.llm.components import components

SHINGLE = 3
RADIUS = 2
TILE = 8192
SEED = 42
ROWS_AT_ONCE = 64  # of a tile, against the whole other tile


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """64 majority bits of the hashes of all shingles of one UTF-8 text."""
    words = raw.lower().split()  # bytes: A-Z only, white space \x20 and \x09-\x0D
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: n - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 65536):
        part = zip(starts[at : at + 65536], stops[at : at + 65536], strict=True)
        h = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in part], "<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, id_col: str = "doc_id") -> DataFrame:
    """(id, tie, fp) of every document; fp as a signed long, tie a hash of the text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(2).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(r or b"", shingle) for r in raws], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["id", "tie", "fp"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    return rows.mapInArrow(hashed, T.StructType([*rows.schema.fields[:2], T.StructField("fp", T.LongType())]))


def forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links between ``a`` and ``b`` within ``radius`` bits that join what all such links join."""
    label = np.arange(len(a) + len(b))
    us, vs = [], []
    for at in range(0, len(a), ROWS_AT_ONCE):
        near = np.bitwise_count(a[at : at + ROWS_AT_ONCE, None] ^ b[None]) <= radius
        for i in np.flatnonzero(near.any(axis=1)):
            me = at + int(i)
            hits = np.flatnonzero(near[i])
            groups, first = np.unique(label[len(a) + hits], return_index=True)
            new = groups != label[me]
            if new.any():
                label[np.isin(label, groups[new])] = label[me]
                us += [int(a[me])] * int(new.sum())
                vs += b[hits[first[new]]].tolist()
    return us, vs


def _half(fp: Column, shift: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))


def links(fps: DataFrame, *, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v): a forest of the links between distinct fingerprints ``fp``."""
    spark: SparkSession = fps.sparkSession
    cells = fps.select("fp", _half(F.col("fp"), 32).alias("hi"), _half(F.col("fp"), 0).alias("lo"))
    # at most 33 x 33 rows
    chunks = {(r.hi, r.lo): -(-r["count"] // tile) for r in cells.groupBy("hi", "lo").count().collect()}
    steps = [(i, j) for i in range(radius + 1) for j in range(-radius, radius + 1) if i + abs(j) <= radius and (i, j) >= (0, 0)]
    near = [
        (h, w, n, h + i, w + j, chunks[h + i, w + j])
        for (h, w), n in chunks.items() for i, j in steps if (h + i, w + j) in chunks
    ]
    if not near:
        return spark.createDataFrame([], "u long, v long")
    near_df = spark.createDataFrame(near, "hi int, lo int, chunks int, hi2 int, lo2 int, chunks2 int")
    sizes = near_df.select("hi", "lo", "chunks").distinct()
    tiles = written(
        cells.join(F.broadcast(sizes), ["hi", "lo"])
        .groupBy("hi", "lo", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int").alias("chunk"))
        .agg(F.collect_list("fp").alias("fps")),  # one tile: its size is bounded by the cut
        "simhash-tiles",
    )
    left = (
        tiles.withColumnRenamed("fps", "a")
        .join(F.broadcast(near_df.drop("chunks")), ["hi", "lo"])
        .withColumn("chunk2", F.explode(F.sequence(F.lit(0), F.col("chunks2") - 1)))
        .where("hi <> hi2 or lo <> lo2 or chunk <= chunk2")
    )
    right = tiles.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.col("chunk").alias("chunk2"), F.col("fps").alias("b"))
    # the work of a pair is the product of its sides: deal pairs out evenly
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-len(near) // 4))
    pairs = left.join(right, ["hi2", "lo2", "chunk2"]).select("a", "b").repartition(tasks)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                x, y = (s.values.to_numpy().view(np.uint64) for s in (a, b))
                us, vs = forest(x, y, radius)
                if us:
                    ends = [np.array(e, np.uint64).view(np.int64) for e in (us, vs)]
                    yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["u", "v"])

    return pairs.mapInArrow(compared, "u long, v long").where("u <> v")


def classes(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE, id_col: str = "doc_id") -> DataFrame:
    """(id, tie, fp, root, component_id) of every document; root names the component."""
    told = written(fingerprints(docs, shingle=shingle, id_col=id_col), "simhash-fps")
    distinct = written(told.groupBy("fp").agg(F.min("id").alias("low")), "simhash-distinct")
    nodes = written(components(links(distinct, radius=radius, tile=tile)), "simhash-nodes")
    lows = nodes.join(distinct, nodes["node"] == distinct["fp"]).groupBy("root").agg(F.min("low").alias("component"))
    # written: both sides of each join are then plain shuffles, and a large component is split
    lows = written(lows.withColumnRenamed("root", "root2"), "simhash-lows")
    member = written(nodes.join(lows, nodes["root"] == lows["root2"]).select("node", "root", "component"), "simhash-members")
    known = written(
        distinct.join(member, distinct["fp"] == member["node"], "left").select(
            F.col("fp").alias("fp2"), F.coalesce("root", "fp").alias("root"), F.coalesce("component", "low").alias("component_id")
        ),
        "simhash-components",
    )
    return told.join(known, told["fp"] == known["fp2"]).drop("fp2")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(id, fingerprint, component_id) of every document; options as for ``classes``."""
    found = classes(docs, **options)
    return found.select(
        F.col("id").alias(options.get("id_col", "doc_id")), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One row of ``docs`` for each component: the least id (null last), then the
    least text hash; of rows alike in both, any one."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "tie")
    kept = classes(docs, id_col=id_col, **options).groupBy("root").agg(F.min(place).alias("first"))
    kept = written(kept.select(F.col("first.id").alias("_id"), F.col("first.tie").alias("_tie")).distinct(), "simhash-kept")
    # the row goes as one struct: no name of its columns can clash with one made here
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("tie"),
    )
    same = rows["id"].eqNullSafe(kept["_id"]) & (rows["tie"] == kept["_tie"])
    order = W.partitionBy("id", "tie").orderBy("id")
    rows = rows.join(kept, same, "left_semi").withColumn("place", F.row_number().over(order)).where("place = 1")
    return rows.select("row.*")
