"""N-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of its distinct word shingles, each a 64-bit hash (two
texts differ in a count only if two of their own few thousand shingles collide).
Two documents link at ``percent`` of their union or more, so a linked pair shares
at least ``T(n)``, ``percent`` of the larger set's size ``n``.

1. Sets. One map shingles whole texts and writes, per document, the set's size,
   its digest and its least hashes. Equal sets are one record from here on.
2. Shared or not. A record with a partner shares at least ``c`` of its least
   ``n - T(n) + c`` hashes with it (fewer than ``n - T(n)`` are missing there).
   Hashes meet by range, packed; a record with too few hashes that any other
   record has goes. Most of a corpus ends here, without a shuffle of its texts.
3. Lists. The survivors' inverted lists have their lengths by one aggregate. A
   record's short lists are its ``n - T(n) + 1`` shortest: every partner is in one
   of them, so they alone say where the record must be searched.
4. Shards. Records with equal least hash (copies, mostly) lie in one shard of
   bounded size; a hot one is cut by hash. A record visits its own shard, and
   each later one that holds a record of one of its short lists.
5. Search. A shard is an inverted index. For each visitor the lists it has there
   are divided: the longest ``L`` are put aside, the short ones are merged into a
   counter per record of the shard, and a record met ``T - L`` times is probed in the long ones by binary search;
   those that reach the pair's required overlap are links. A pair whose ends are
   joined already is not probed, so a task gives a forest, not all pairs.
6. Components by star steps; equal sets take their record's component by a join.

Scale: shuffles hold packed least hashes (two fifths of all), then survivors only.
A visit ships a set once; the number of visits of a hot group of different
near-copies is its size times its shards. Driver: four counts.

Defined cases: a null text or one without words has an empty set and links with
nothing (its component is its own id); fewer words than a shingle: the whole
sequence is one; null ids take no part in the least id (a component of null ids
only has a null id); repeated rows are documents of their own; empty input gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest, xxh64_intdigest

from tidemark.llm.common import written
from tidemark.llm.components import components
from tidemark.session import bounded_broadcast, lineage_root

SHINGLE = 5
PERCENT = 80
SEED = 42
WORDS = 400_000  # word hashes that a worker keeps
BYTES_PER_BATCH = 8 << 20
FLUSH = 1_000_000  # least hashes packed together
RANGE = 1_000_000  # hashes that meet in one range
SHARD = 250_000  # shingles of a shard's records, about
SMALL = 1_000_000  # survivors up to here are broadcast as row numbers
MU = 0.01  # weight of a binary probe against a step of the merge, for the division
MERGE = 8  # steps of a merge that take as long as a binary probe
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class WordHashes(dict):
    """Hashes of words, as signed 64-bit numbers."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        h = xxh64_intdigest(word, SEED)
        self[word] = h = h - (1 << 64) if h >= 1 << 63 else h
        return h


_HASHES = WordHashes()


def shingle_set(raw: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of one UTF-8 text, as hashes in order."""
    words = raw.lower().split()  # bytes: A-Z only, white space \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words)).view(np.uint64)
    k = min(shingle, len(h))
    x = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        x ^= h[j : j + len(x)]
        x *= _MIX[j % len(_MIX)]
        x ^= x >> np.uint64(29)
    return np.unique(x)


def least_overlap(n, percent: int):
    """T(n): what a set of ``n`` shares at least with a partner."""
    return -(-percent * n // 100)


def shared_least(n, percent: int):
    """c(n): a fifth of the set; how far the least hashes go on."""
    return -(-n // 5)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of bounded bytes, a row at least."""
    size = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)))
    cuts = [0, *(np.flatnonzero(np.diff(size // BYTES_PER_BATCH)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield batch.slice(a, b - a)


def shingled(docs: DataFrame, *, shingle: int, percent: int, id_col: str) -> DataFrame:
    """(row, id, text, n, d1, d2, least): size, digest and least hashes of every set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 2):
                n, digests, least = [], [], []
                for raw in part.column(2).cast(pa.binary()).to_pylist():
                    s = shingle_set(raw or b"", shingle)
                    n.append(len(s))
                    digests.append(xxh3_128_digest(s.tobytes()))
                    least.append(s[: len(s) - least_overlap(len(s), percent) + shared_least(len(s), percent)].tobytes())
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                columns = [pa.array(n, pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in d.T), pa.array(least, pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], ["row", "id", "text", "n", "d1", "d2", "least"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    more = [T.StructField(c, T.LongType()) for c in ("n", "d1", "d2")]
    return rows.mapInArrow(work, T.StructType([*rows.schema.fields, *more, T.StructField("least", T.BinaryType())]))


def shared_counts(sets: DataFrame, total: int) -> DataFrame:
    """(d1, shared): how many of each set's least hashes any other set has, at least."""
    bits = max(1, math.ceil(math.log2(max(2, total / RANGE))))
    none = -1  # stands for several sets of one flush: the hash is shared

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["range", "hashes", "owners", "digests", "own", "shared"]

        def rows(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
            digests = np.array(list(held), np.int64)
            h = np.concatenate(list(held.values()))
            owner = np.repeat(np.arange(len(digests)), [len(x) for x in held.values()])
            order = np.argsort(h, kind="stable")
            h, owner = h[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            many = np.diff(np.append(first, len(h))) > 1
            # shared within the flush: counted here, sent once without an owner
            met = np.bincount(owner[np.repeat(many, np.diff(np.append(first, len(h))))], minlength=len(digests))
            h, owner = h[first], np.where(many, none, owner[first])
            where = (h >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.searchsorted(where, np.arange((1 << bits) + 1))
            # the flush's own counts go along to any range
            out: list[tuple] = [(int(where[0]), b"", b"", b"", digests.tobytes(), met.astype(np.int64).tobytes())]
            low = ((h << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
            for r, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                if a < b:
                    used, place = np.unique(owner[a:b], return_inverse=True)
                    told = np.where(used == none, 0, digests[used])
                    place = np.where(owner[a:b] == none, none, place)
                    out.append((r, low[a:b].tobytes(), place.astype("<i4").tobytes(), told.tobytes(), b"", b""))
            kinds = [pa.int64(), *[pa.binary()] * 5]
            for at in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[at : at + 64], strict=True), kinds, strict=True)], names)

        held, size = {}, 0
        for batch in batches:
            for d, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if d not in held:
                    held[d] = np.frombuffer(raw.as_py(), np.uint64)
                    size += len(held[d])
                if size >= FLUSH:
                    yield from rows(held)
                    held, size = {}, 0
        if held:
            yield from rows(held)

    def met(t: pa.Table) -> pa.Table:
        hs, ds, told = [np.zeros(0, "<u4")], [(np.zeros(0, np.int64), np.zeros(0, bool))], [(np.zeros(0, np.int64),) * 2]
        for hashes, owners, digests, own, shared in zip(*(t.column(c).to_pylist() for c in t.column_names[1:]), strict=True):
            if own:
                told.append((np.frombuffer(own, np.int64), np.frombuffer(shared, np.int64)))
                continue
            owner, digest = np.frombuffer(owners, "<i4"), np.frombuffer(digests, np.int64)
            hs.append(np.frombuffer(hashes, "<u4"))
            ds.append((np.where(owner == none, 0, digest[owner]), owner == none))
        h, d, many = np.concatenate(hs), np.concatenate([x for x, _ in ds]), np.concatenate([x for _, x in ds])
        order = np.lexsort((d, many, h))
        h, d, many = h[order], d[order], many[order]
        # a copy of a set in another flush is the same set
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1]) | (many[1:] != many[:-1])
        h, d, many = h[fresh], d[fresh], many[fresh]
        group = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))[: len(h)]
        weight = np.bincount(group, np.where(many, 2, 1))
        found, n = np.unique(d[~many & (weight[group] > 1)], return_counts=True)
        own, within = (np.concatenate(x) for x in zip(*told, strict=True))
        return pa.table({"d1": np.concatenate([found, own]), "across": np.concatenate([n, 0 * own]), "within": np.concatenate([0 * found, within])})

    kinds = "range long, hashes binary, owners binary, digests binary, own binary, shared binary"
    sent = sets.where("n > 0").select("d1", "least").mapInArrow(packed, kinds)
    counts = sent.groupBy("range").applyInArrow(met, "d1 long, across long, within long")
    # a set may stand in several flushes: what it shares within one is counted once
    return counts.groupBy("d1").agg((F.sum("across") + F.max("within")).alias("shared"))


class Index:
    """Inverted lists of one shard's records."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        self.size = np.array([len(s) for s in sets], np.int64)
        h = np.concatenate(sets)
        member = np.repeat(np.arange(self.n), self.size)
        order = np.argsort(h, kind="stable")
        h, self.member = h[order], member[order]
        self.start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        self.hashes = h[self.start]
        self.stop = np.append(self.start[1:], len(h))
        # list and member as one number, in order: what a binary probe looks for
        self.keys = np.repeat(np.arange(len(self.start)), self.stop - self.start) * self.n + self.member

    def lists(self, s: np.ndarray) -> np.ndarray:
        """The lists of a set's shingles, shortest first."""
        at = np.minimum(np.searchsorted(self.hashes, s), len(self.hashes) - 1)
        found = at[self.hashes[at] == s]
        return found[np.argsort(self.stop[found] - self.start[found], kind="stable")]

    def candidates(self, found: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(members, times met in short lists, long lists): DivideSkip's division and merge."""
        longest = int(self.stop[found[-1]] - self.start[found[-1]])
        aside = min(least - 1, int(least / (MU * math.log2(longest + 1) + 1)))
        short, long = found[: len(found) - aside], found[len(found) - aside :]
        met = self.merged(short)
        members = np.flatnonzero(met >= least - aside)
        return members, met[members], long

    def merged(self, some: np.ndarray) -> np.ndarray:
        """In how many of some lists each member of the shard is."""
        runs = [self.member[a:b] for a, b in zip(self.start[some].tolist(), self.stop[some].tolist(), strict=True)]
        return np.bincount(np.concatenate([self.member[:0], *runs]), minlength=self.n)

    def probe(self, members: np.ndarray, long: np.ndarray) -> np.ndarray:
        """In how many of the long lists each member is: by binary search, or by
        merging them too where there are as many probes as a merge has steps."""
        if (self.stop[long] - self.start[long]).sum() <= MERGE * len(long) * len(members):
            return self.merged(long)[members]
        want = (long[:, None] * self.n + members[None]).ravel()
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return (self.keys[at] == want).reshape(len(long), len(members)).sum(axis=0)


def search(index: Index, visitors: list[np.ndarray], own: list[int], percent: int) -> Iterator[tuple[int, int]]:
    """(visitor, member) links that join what all links between them join;
    ``own``: the member that a visitor is, or -1."""
    label = np.arange(index.n + len(visitors))
    for v, s in enumerate(visitors):
        me = own[v] if own[v] >= 0 else index.n + v
        least = least_overlap(len(s), percent)
        found = index.lists(s)
        if len(found) < least:
            continue
        members, times, long = index.candidates(found, least)
        fit = (100 * np.minimum(index.size[members], len(s)) >= percent * np.maximum(index.size[members], len(s))) & (members != own[v])
        members, times = members[fit], times[fit]
        apart = label[members] != label[me]
        members, times = members[apart], times[apart]
        if not len(members):
            continue
        # all at once: a visitor just below the bound of a large group meets each of its members
        overlap = times + index.probe(members, long)
        linked = 100 * overlap >= percent * (len(s) + index.size[members] - overlap)
        for m in members[linked].tolist():
            if label[m] != label[me]:  # a link joins all of a group
                label[label == label[m]] = label[me]
                yield v, m


def links(survivors: DataFrame, *, percent: int, shard: int = SHARD) -> DataFrame:
    """(u, v): a forest of the links between records (row, n, low, hashes)."""

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                sets = [np.frombuffer(x, np.int64) for x in part.column(1).to_pylist()]
                rows = np.repeat(part.column(0).to_numpy(), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.concatenate(sets))], ["row", "h"])

    everywhere = survivors.select("row", "hashes").mapInArrow(postings, "row long, h long")
    lengths = everywhere.groupBy("h").agg(F.count(F.lit(1)).alias("length")).where("length > 1").withColumnRenamed("h", "of")
    shared = everywhere.join(lengths, F.col("h") == F.col("of")).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("length", "h"))).alias("lists"))  # at most one document's shingles
    n_short = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100).cast("long") + 1 - (F.col("n") - F.size("lists"))  # lists of one record are the shortest
    short = survivors.select(F.col("row").alias("at"), "n").join(shared, F.col("at") == F.col("row")).where(n_short > 0)
    short = short.select("row", F.explode(F.slice("lists", F.lit(1), n_short.cast("int"))).alias("l")).select("row", F.col("l.h").alias("h"))
    short = written(short, "overlap-short")
    met = short.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("h").alias("of"))
    short = written(short.join(met, F.col("h") == F.col("of")).select("row", "h"), "overlap-met")

    # shards of bounded size: records by their least hash, a hot one cut by row
    live = survivors.join(short.select(F.col("row").alias("at")).distinct(), F.col("row") == F.col("at"), "left_semi")
    total = live.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // shard))
    bucket = F.pmod(F.xxhash64("low"), F.lit(buckets))
    weights = live.groupBy(bucket.alias("b")).agg(F.greatest(F.ceil(F.sum("n") / (2 * shard)), F.lit(1)).cast("long").alias("cuts"))
    placed = live.withColumn("bucket", bucket).join(weights, F.col("bucket") == F.col("b"))
    sid = F.col("bucket") * (1 << 24) + F.pmod(F.xxhash64(F.lit("cut"), F.col("row")), F.col("cuts"))
    placed = written(placed.select("row", "n", "hashes", sid.alias("shard")), "overlap-placed")

    home = placed.select(F.col("row").alias("at"), "shard")
    homed = written(short.join(home, F.col("row") == F.col("at")).select("row", "h", "shard"), "overlap-homes")
    holds = homed.select(F.col("h").alias("of"), F.col("shard").alias("to")).distinct()
    away = homed.join(holds, (F.col("h") == F.col("of")) & (F.col("to") > F.col("shard"))).select("row", "to").distinct()
    visits = written(away.unionByName(placed.select("row", F.col("shard").alias("to"))), "overlap-visits")
    sets = placed.select(F.col("row").alias("at"), "n", F.col("hashes").alias("set"))
    queries = visits.join(sets, F.col("row") == F.col("at"))
    # a shard with many visitors is searched in pieces
    pieces = visits.join(sets.select("at", "n"), F.col("row") == F.col("at")).groupBy("to").agg(F.ceil(F.sum("n") / (4 * shard)).cast("long").alias("pieces"))
    pieces = written(pieces.withColumnRenamed("to", "goes"), "overlap-pieces")
    queries = queries.join(pieces, F.col("to") == F.col("goes")).select(
        "to", F.pmod(F.xxhash64(F.lit("piece"), F.col("row")), F.col("pieces")).alias("piece"), "row", F.col("set").alias("hashes"))
    index = placed.join(pieces, F.col("shard") == F.col("goes")).select(
        F.col("shard").alias("to"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"), F.col("row").alias("row"),
        F.col("hashes").alias("hashes"))

    def found(asked: pa.Table, held: pa.Table) -> pa.Table:
        us, vs = [], []
        if asked.num_rows and held.num_rows:
            rows, askers = held.column("row").to_pylist(), asked.column("row").to_pylist()
            at = {r: i for i, r in enumerate(rows)}
            index, visitors = (Index([np.frombuffer(x, np.uint64) for x in held.column("hashes").to_pylist()]),
                               [np.frombuffer(x, np.uint64) for x in asked.column("hashes").to_pylist()])
            for v, m in search(index, visitors, [at.get(r, -1) for r in askers], percent):
                us.append(askers[v])
                vs.append(rows[m])
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return queries.groupBy("to", "piece").cogroup(index.groupBy("to", "piece")).applyInArrow(found, "u long, v long")


def _stored(sets: DataFrame) -> DataFrame:
    """Written once in the shared folder, the texts packed tighter than by default."""
    spark = sets.sparkSession
    path = f"{lineage_root(spark)}/overlap-sets-{uuid.uuid4().hex}"
    sets.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(sets.schema).parquet(path)


def overlap_classes(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, shard: int = SHARD, id_col: str = "doc_id") -> DataFrame:
    """(id, n_shingles, component_id) of every document."""
    sets = _stored(shingled(docs, shingle=shingle, percent=percent, id_col=id_col))
    full = sets.where("n > 0")
    # one record per set: the first of its rows stands for all
    records = written(full.groupBy("d1", "d2").agg(F.first("n").alias("n"), F.min("id").alias("low"), F.min("row").alias("row")), "overlap-records")
    total = sets.agg(F.sum(F.octet_length("least") / 8)).first()[0] or 0
    counts = shared_counts(sets, int(total)).withColumnRenamed("d1", "d")
    n = F.ceil(F.lit(percent) * F.col("n") / 100)  # the least size of a partner
    alive = records.join(counts, F.col("d1") == F.col("d")).where(F.col("shared") >= F.ceil(n / 5)).select(F.col("row").alias("at"))
    alive = written(alive, "overlap-alive")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                found = [shingle_set(raw or b"", shingle) for raw in part.column(1).cast(pa.binary()).to_pylist()]
                columns = [pa.array([len(s) for s in found], pa.int64()), pa.array([int(s[0].view(np.int64)) for s in found], pa.int64()),
                           pa.array([s.tobytes() for s in found], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["row", "n", "low", "hashes"])

    texts = sets.select("row", "text").join(bounded_broadcast(alive, SMALL), F.col("row") == F.col("at"), "left_semi")
    survivors = written(texts.mapInArrow(work, "row long, n long, low long, hashes binary"), "overlap-survivors")
    nodes = written(components(links(survivors, percent=percent, shard=shard)), "overlap-nodes")
    lows = nodes.join(records.select(F.col("row").alias("at"), "low"), F.col("node") == F.col("at")).groupBy("root").agg(F.min("low").alias("component"))
    lows = written(lows.withColumnRenamed("root", "root2"), "overlap-lows")
    member = written(nodes.join(lows, F.col("root") == F.col("root2")).select("node", "component"), "overlap-members")
    known = records.join(member, F.col("row") == F.col("node"), "left").select(
        F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("node").isNotNull().alias("joined"), "component", "low")
    known = written(known, "overlap-components")
    out = sets.select("id", "n", "d1", "d2").join(known, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & (F.col("n") > 0), "left")
    component: Column = F.when(F.col("n") == 0, F.col("id")).when(F.col("joined"), F.col("component")).otherwise(F.col("low"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
