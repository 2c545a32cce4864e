"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A (tokenizers, byte-level) encodes a space and the text; tokenizer B
(sentencepiece, which adds that space) the text.

1. Units. The text is cut before every single space between two characters that
   are no white space. A's pattern starts a new piece there and B's vocabulary
   has no piece that goes on past a space (both are proved from the files; else
   a text is one unit), so the tokens of a unit do not depend on the rest, and
   both tokenizers have a token end at its end. A worker aligns a unit once and
   keeps a few hundred thousand, those it met more than once longest.
2. Spans. A's character offsets and the spans of B's proto give coarse ends in
   bytes. A unit with a span that does not hold exactly its token's bytes (a
   character over several tokens, byte fallback) is refined by the lengths of
   the decoded bytes. A text whose joined bytes differ from its own has no tokens.
3. Groups end where both have a token end. Between two neighbouring ends of
   either lies the overlap of one A and one B token: a link.
4. A document gives its distinct linked id pairs with their times. Counts per
   pair are partial sums per task, then one aggregate.
5. Counts go back by lookup in the pairs of highest count, at most
   ``BROADCAST_PAIRS`` of them; a pair below that cut goes through an equi join
   on the pair. A pair that occurs in one document only needs neither where the
   lookup holds all others. The best count of each A id is bounded by the vocabulary.

Scale: texts are never shuffled; the first shuffle holds distinct pairs per
task, the second only pairs below the cut. Driver: at most 64 rows of a
histogram, the bounded lookup, one number per A id.

Defined cases: texts null, empty or with differing bytes: zeros, null groups;
special strings inside texts are plain text; a very long text without spaces is
one unit, encoded by the libraries whole; repeated rows each give a row and each
count; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import written
from tidemark.llm.token_counts import byte_of_char, load

UNITS = 500_000  # aligned units that a worker keeps, and their bytes
UNIT_BYTES = 64 << 20
SLICE_BYTES = 2 << 20  # of texts taken together
BROADCAST_PAIRS = 2_000_000
FLUSH_PAIRS = 4_000_000
CUT = re.compile(r"(?<=\S) (?=\S)")
SOUND = re.compile(r" \S(?:.*\S)?\Z", re.DOTALL)  # may stand beside other units


class Coded:
    """One tokenizer's tokens of a run of units: ids, ends in bytes, the unit of
    each, and which units hold just their own bytes."""

    def __init__(self, ids: np.ndarray, cuts: np.ndarray, unit: np.ndarray, table: list[bytes], lengths: np.ndarray, raw: bytes, starts: np.ndarray):
        self.ids, self.unit = ids, unit
        size = lengths[ids]
        n = np.bincount(unit, minlength=len(starts) - 1)
        done = np.cumsum(size)
        first = np.concatenate([[0], np.cumsum(n)])[:-1]
        before = np.concatenate([[0], done])[first]  # bytes of all tokens before each unit
        # coarse: the spans' own ends. A unit with a span that is not just its
        # token's bytes is refined by the lengths of the decoded bytes
        span = np.diff(cuts, prepend=0)
        coarse = np.bincount(unit[span != size], minlength=len(n)) == 0
        self.ends = np.where(coarse[unit], cuts, starts[unit] + done - before[unit])
        joined = b"".join(map(table.__getitem__, ids.tolist()))
        if joined == raw:
            self.same = np.ones(len(n), bool)
        else:
            after = before + np.bincount(unit, size, len(n)).astype(np.int64)
            own = zip(before.tolist(), after.tolist(), starts.tolist(), starts[1:].tolist(), strict=False)
            self.same = np.array([joined[i:j] == raw[k:m] for i, j, k, m in own], bool)

    def keep(self, units: np.ndarray) -> None:
        on = units[self.unit]
        self.ids, self.ends, self.unit = self.ids[on], self.ends[on], self.unit[on]


class Pair:
    """Both tokenizers over runs of units."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = load(path_a)
        self.a.encode_special_tokens = True  # their strings inside texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = byte_of_char()
        vocab = self.a.get_vocab()
        self.n_a, self.n_b = max(vocab.values()) + 1, self.b.get_piece_size()
        self.bytes_a, self.bytes_b = [b""] * self.n_a, []
        for s, i in vocab.items():
            self.bytes_a[i] = bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
        for i in range(self.n_b):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a, self.size_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        # how an id is written inside a group and at its end
        self.told = [np.array([f"{i}{c}" for i in range(n)], object) for n, c in ((self.n_a, ","), (self.n_a, "|"), (self.n_b, ","), (self.n_b, ";"))]
        self.units = self.cuttable()

    def cuttable(self) -> bool:
        """Does no token of either depend on what lies across a cut?"""
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto.FromString(self.b.serialized_model_proto())
        rules = model.normalizer_spec
        pieces = (self.b.id_to_piece(i) for i in range(self.n_b) if not self.b.is_byte(i) and not self.b.is_control(i))
        b_holds = (
            model.trainer_spec.model_type == pb.TrainerSpec.BPE and not rules.precompiled_charsmap and rules.add_dummy_prefix
            and rules.escape_whitespaces and not rules.remove_extra_whitespaces and not any("▁" in p.lstrip("▁") for p in pieces)
        )
        # a byte-level pattern lets a space begin a piece, never go on in one
        probe = [s for s, _ in self.a.pre_tokenizer.pre_tokenize_str("x. y 1 '? z")] if self.a.pre_tokenizer else []
        return b_holds and self.a.normalizer is None and probe == ["x", ".", "Ġy", "Ġ1", "Ġ'?", "Ġz"]

    def cut(self, text: str) -> list[str]:
        """Units of a space and the text; each begins with a space."""
        return [" " + u for u in CUT.split(text)] if self.units else [" " + text]

    def encode(self, units: list[str]) -> tuple[Coded, Coded]:
        """Tokens of units that may stand side by side (or of one unit)."""
        text = "".join(units)
        raw = text.encode()
        u8 = np.frombuffer(raw, np.uint8)
        byte_of = np.append(np.flatnonzero((u8 & 0xC0) != 0x80), len(raw))
        chars = np.cumsum([0, *map(len, units)])
        starts = byte_of[chars]
        a = self.a.encode(text, add_special_tokens=False)
        ids = np.array(a.ids, np.int64)
        stops = np.fromiter(map(itemgetter(1), a.offsets), np.int64, len(ids))
        coded_a = Coded(ids, byte_of[stops], np.searchsorted(chars, stops) - 1, self.bytes_a, self.size_a, raw, starts)
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        spans = np.fromiter(chain.from_iterable((p.id, p.end) for p in pieces), np.int64, 2 * len(pieces)).reshape(-1, 2)
        # B adds the first space itself; the first pieces of a character's bytes end where it begins
        stops, begins = spans[:, 1] + 1, np.concatenate([[0], spans[:, 1] + 1])[:-1]
        unit = np.searchsorted(starts, np.minimum(begins, len(raw) - 1), side="right") - 1
        return coded_a, Coded(spans[:, 0], stops, unit, self.bytes_b, self.size_b, raw, starts)


def aligned_units(pair: Pair, units: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Per unit (n_a, n_b, n_groups, n_links, do both hold its bytes?) and its
    groups; and all links' keys, unit after unit."""
    a, b = pair.encode(units)
    same = a.same & b.same
    n = len(units)
    a.keep(same)
    b.keep(same)
    # between two neighbouring ends lies one overlap of one token of each: a link
    ends = np.union1d(a.ends, b.ends)
    at_a, at_b = np.searchsorted(a.ends, ends), np.searchsorted(b.ends, ends)
    keys = a.ids[at_a] * pair.n_b + b.ids[at_b] if len(ends) else np.zeros(0, np.int64)
    both = ends[(a.ends[at_a] == ends) & (b.ends[at_b] == ends)] if len(ends) else ends
    group_a, group_b = np.searchsorted(both, a.ends), np.searchsorted(both, b.ends)
    last_a, last_b = np.isin(a.ends, both), np.isin(b.ends, both)
    words = np.concatenate([np.where(last_a, pair.told[1][a.ids], pair.told[0][a.ids]), np.where(last_b, pair.told[3][b.ids], pair.told[2][b.ids])])
    words = words[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")].tolist()
    n_a, n_b = np.bincount(a.unit, minlength=n), np.bincount(b.unit, minlength=n)
    n_groups, n_links = np.bincount(a.unit[last_a], minlength=n), np.bincount(a.unit[at_a], minlength=n)
    edges = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    groups = ["".join(words[i:j])[:-1] for i, j in zip(edges, edges[1:], strict=False)]
    return np.column_stack([n_a, n_b, n_groups, n_links, same]).astype(np.int64), groups, keys


class Units(dict):
    """Aligned units by text: the number of each, and what it holds, in arrays."""

    def __init__(self, pair: Pair):
        super().__init__()
        self.pair = pair
        self.drop()

    def drop(self) -> None:
        self.clear()
        self.groups: list[str] = []
        self.counts, self.keys, self.starts = np.zeros((0, 5), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.used = np.zeros(0, np.int64)
        self.size = 0

    def age(self) -> None:
        """Keeps the units that were met again since the last time, at most half of the room."""
        if self.size > UNIT_BYTES:
            return self.drop()
        often = np.flatnonzero(self.used > 1)
        if len(often) > UNITS // 2:
            often = np.sort(np.argsort(-self.used, kind="stable")[: UNITS // 2])
        texts, groups, n = list(self), self.groups, self.counts[often, 3]
        counts, keys = self.counts[often], self.keys[np.repeat(self.starts[often] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        self.drop()
        for new, old in enumerate(often.tolist()):  # units stand in the order of their numbers
            self[texts[old]] = new
            self.groups.append(groups[old])
            self.size += len(texts[old]) + len(groups[old])
        self.counts, self.keys, self.used = counts, keys, np.zeros(len(often), np.int64)
        self.starts = np.concatenate([[0], np.cumsum(n)])

    def add(self, units: list[str]) -> None:
        # units that end or go on in white space stay alone, as do those with B's own sign for it
        clean = ["▁" not in u and bool(SOUND.match(u)) for u in units] if self.pair.units else [False] * len(units)
        runs = [[u for u, c in zip(units, clean, strict=True) if c], *([u] for u, c in zip(units, clean, strict=True) if not c)]
        told = [(run, *aligned_units(self.pair, run)) for run in runs if run]
        for run, _, groups, _ in told:
            self.update(zip(run, range(len(self.groups), len(self.groups) + len(run)), strict=True))
            self.groups += groups
            self.size += sum(map(len, run)) + sum(map(len, groups))
        self.counts = np.concatenate([self.counts, *(c for _, c, _, _ in told)])
        self.keys = np.concatenate([self.keys, *(k for *_, k in told)])
        self.starts = np.concatenate([[0], np.cumsum(self.counts[:, 3])])

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the units of each text."""
        if len(self) > UNITS or self.size > UNIT_BYTES:
            self.age()
        cut = [self.pair.cut(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(self)
        if new:
            self.add(sorted(new))
        numbers = [np.fromiter(map(self.__getitem__, units), np.int64, len(units)) for units in cut]
        self.used = np.bincount(np.concatenate(numbers), minlength=len(self.groups)) + np.append(self.used, np.zeros(len(self.groups) - len(self.used), np.int64))
        return numbers


_UNITS: dict[tuple[str, str], Units] = {}  # one per worker and pair of files


def _units(path_a: str, path_b: str) -> Units:
    if (path_a, path_b) not in _UNITS:
        _UNITS.clear()
        _UNITS[path_a, path_b] = Units(Pair(path_a, path_b))
    return _UNITS[path_a, path_b]


def _aligned(known: Units, texts: list[str]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, keys, times) of each text, None without tokens."""
    units = known.numbers(texts)
    counts, starts, keys = known.counts, known.starts, known.keys
    flat = np.concatenate(units)
    edges = np.cumsum([len(u) for u in units])
    total = np.add.reduceat(counts[flat], np.concatenate([[0], edges[:-1]]), axis=0)
    # every link of every unit, with its text: distinct pairs per text and their times
    n = counts[flat, 3]
    text_of = np.repeat(np.arange(len(units)), [len(u) for u in units])
    at = np.repeat(starts[flat] - np.cumsum(n) + n, n) + np.arange(n.sum())
    span = int(keys.max(initial=0)) + 1
    both, times = np.unique(np.repeat(text_of, n) * span + keys[at], return_counts=True)
    own = np.searchsorted(both // span, np.arange(len(units) + 1))
    both %= span
    out = []
    for t, u in enumerate(units):
        if total[t, 4] < len(u):
            out.append(None)
            continue
        a, b = own[t], own[t + 1]
        joined = ";".join(map(known.groups.__getitem__, u.tolist()))
        out.append((*total[t, :4].tolist(), joined, both[a:b].tobytes(), times[a:b].astype(np.uint32).tobytes()))
    return out


def align(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, keys, times) of every document.

    ``groups``: ``a1,a2|b1;a3|b2,b3``, null without tokens. ``keys``: the distinct
    linked pairs in order, as little-endian 64-bit numbers ``a * |B| + b``;
    ``times``: how often each is linked, as 32-bit numbers.
    """
    nothing = (0, 0, 0, 0, None, b"", b"")
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "keys", "times"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _units(path_a, path_b)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                first, texts, size = at, [], 0
                while at < batch.num_rows and size < SLICE_BYTES:
                    texts.append(batch.column(1)[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                full = iter(_aligned(known, some) if (some := [t for t in texts if t]) else [])
                rows = [(next(full) if t else None) or nothing for t in texts]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, at - first), *columns], ["id", *names])

    rows = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in names[:4]],
                        T.StructField("groups", T.StringType()), *[T.StructField(c, T.BinaryType()) for c in names[5:]]])
    return rows.mapInArrow(aligned, out).withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(key, n): in how many documents each pair is linked."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["key", "n"])

        for batch in batches:
            for raw in batch.column(0):
                held.append(np.frombuffer(raw.as_py(), "<i8"))
                size += len(held[-1])
                if size >= FLUSH_PAIRS:
                    yield rows()
                    size = 0
        if held:
            yield rows()

    return aligned.select("keys").mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> int:
    """The least power of two of the count at which at most ``most`` pairs are left."""
    power = F.floor(F.log2("n")).cast("int")
    left, least = 0, 64
    for r in counts.groupBy(power.alias("p")).count().orderBy(F.desc("p")).collect():
        left += r["count"]
        if left > most:
            break
        least = r.p
    return least


def link_counts(aligned: DataFrame, path_a: str, path_b: str, *, most: int = BROADCAST_PAIRS, id_col: str = "doc_id") -> DataFrame:
    """``aligned`` (written, without groups) with ``n_best`` and ``count_sum``: how many links have the
    highest count of their A id, and the sum of the counts over all links."""
    spark = aligned.sparkSession
    pair = Pair(path_a, path_b)
    n_a, n_b = pair.n_a, pair.n_b
    stored = written(aligned.withColumn("_row", F.monotonically_increasing_id()), "spans-aligned")
    counts = written(pair_counts(stored), "spans-counts")
    # one row per A id: bounded by the vocabulary
    highest = counts.groupBy((F.col("key") / n_b).cast("long").alias("a")).agg(F.max("n").alias("top"))
    best = np.zeros(n_a, np.int64)
    for r in highest.toLocalIterator():
        best[r.a] = r.top
    least = max(1, frequent(counts, most))  # pairs of one document are found without the lookup
    power = F.floor(F.log2("n")).cast("int")
    found = counts.where(power >= least).toArrow()  # at most ``most`` rows
    order = np.argsort(found.column("key").to_numpy())
    lookup = spark.sparkContext.broadcast((found.column("key").to_numpy()[order], found.column("n").to_numpy()[order], best))
    others = counts.where((power < least) & (F.col("n") > 1))

    def looked_up(keys: bytes, times: bytes):
        top, n, _ = lookup.value
        k, t = np.frombuffer(keys, "<i8"), np.frombuffer(times, "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(top, k), max(0, len(top) - 1))
        hit = top[at] == k if len(top) else np.zeros(len(k), bool)
        return k, t, hit, n[at[hit]]

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, bests = [], []
            for keys, times in zip(batch.column(1), batch.column(2), strict=True):
                k, t, hit, n = looked_up(keys.as_py(), times.as_py())
                sums.append(int((n * t[hit]).sum()))
                bests.append(int(t[hit][n == lookup.value[2][k[hit] // n_b]].sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64()), pa.array(bests, pa.int64())], ["_row", "s", "b"])

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, keys, times in zip(*batch.columns, strict=True):
                k, t, hit, _ = looked_up(keys.as_py(), times.as_py())
                if not hit.all():
                    k, t = k[~hit], t[~hit]
                    cols = [np.full(len(k), row.as_py()), k, t, lookup.value[2][k // n_b]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["_row", "key", "t", "top"])

    asked = stored.select("_row", "keys", "times")
    parts = asked.mapInArrow(known, "_row long, s long, b long")
    rest = asked.mapInArrow(unknown, "_row long, key long, t long, top long")
    if not others.isEmpty():
        rest = rest.join(others.withColumnRenamed("key", "other"), F.col("key") == F.col("other"), "left")
    else:
        rest = rest.withColumn("n", F.lit(1).cast("long"))
    n = F.coalesce("n", F.lit(1).cast("long"))
    rest = rest.select("_row", (n * F.col("t")).alias("s"), F.when(n == F.col("top"), F.col("t")).otherwise(0).alias("b"))
    sums = parts.unionByName(rest).groupBy("_row").agg(F.sum("s").alias("count_sum"), F.sum("b").alias("n_best")).withColumnRenamed("_row", "_of")
    joined = stored.drop("keys", "times").join(sums, F.col("_row") == F.col("_of"))
    return joined.drop("_row", "_of")
