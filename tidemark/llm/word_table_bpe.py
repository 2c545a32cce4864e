"""BPE encoding and decoding through a table of distinct words.

1. Texts are normalised (the library's normaliser) and split into words in
   Spark tasks; each task gives its distinct words with their counts, and one
   aggregate makes the table of distinct words.
2. Every distinct word is encoded once, by the library's merges: words that
   occur more than once in the table's own job, a word that occurs once in the
   whole corpus where it stands.
3. Ids go back to the documents by position: the most frequent words, at most
   ``broadcast_words`` of them and at most ``broadcast_bytes`` of words and
   ids, none of them over ``LONG_WORD`` bytes, are broadcast (proven bounds: a
   word has no greatest length); a document with another word of the table
   takes its words from it by an equi join on the word, grouped by its text.
   While the bounds hold every repeated word, that join has nothing to add and
   is not run.
4. Ids are decoded by a join, by position, with the id-to-piece table, which
   the vocabulary bounds; in the tasks that encode, where both are asked for
   (``encode`` with ``then``): a task then has one Python worker, not two.

Scale: what is shuffled is distinct words per task, and beyond the bound the
texts with a rare or long word, once. The broadcast does not grow with the
corpus. The number and bytes of words at each power of two of the count come
to the driver (at most 64 rows).

Special strings inside texts are their own ids, as the library's default has
it. Splitting is exact: a text with a code point that the two regex engines
might class differently is split by the library (see token_counts). Most texts
need no normaliser: where every code point is proved to keep to itself (see
PlainChars), normalising is lower-casing. A text equal to the row before it,
as the copies of a mix are, is split and encoded once.

Defined cases: a null text is empty (no ids, decoded to nothing); repeated rows
each give a row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh64_intdigest

from tidemark.llm.common import written
from tidemark.llm.token_counts import ClassProof, byte_of_char, load

BROADCAST_WORDS = 1_500_000
BROADCAST_BYTES = 96 << 20  # of words and their ids
LONG_WORD = 1024  # bytes of a word and its ids
FLUSH_WORDS = 200_000  # a task gives its distinct words whenever it has so many
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PROBES = (("x", r"\p{L}"), ("?", r"[^\s\p{L}\p{N}]"), ("", r"\S"))
# the same words in texts of plain code points, by the standard library's classes
PLAIN_WORDS = r"[^\W\d_]+|\d|'(?:[stmd]|re|ve|ll)|(?:[^\s\w]|_)+"
PLAIN_PROBES = (("x", r"[^\W\d_]"), ("?", r"[^\s\w]|_"), ("", r"\S"))
# no code point here joins the one before it under NFC, in any version of Unicode
UNJOINED = (range(0x300), range(0x370, 0x483), range(0x2010, 0x2028), range(0x4E00, 0xA000))
BYTES_PER_BATCH = 8 << 20
CACHE_WORDS = 200_000


class PlainChars:
    """Code points that the library is proved to lower alone and to class as
    PLAIN_WORDS does. They are in UNJOINED, so NFC changes a text of them only
    code point by code point; capital sigma, whose lower case hangs on its
    neighbours, is none. White space may become other white space: it is no
    part of a word."""

    def __init__(self, tok, flags: int = 0):
        self.normal, self.pieces = tok.normalizer.normalize_str, tok.pre_tokenizer.pre_tokenize_str
        self.probes = [(x, re.compile(c, flags)) for x, c in PLAIN_PROBES]
        self.space = re.compile(r"\s", flags)
        self.good: set[str] = set()
        self.bad: set[str] = set()

    def proved(self, c: str) -> bool:
        if c == "\u03a3" or not any(ord(c) in r for r in UNJOINED):
            return False
        normal, low = self.normal(f"x{c}x"), c.lower()
        if normal == "x x":
            return bool(self.space.fullmatch(c))
        return len(low) == 1 and normal == f"x{low}x" and all(
            (len(self.pieces(x + low + x)) == 1) == bool(own.fullmatch(low)) for x, own in self.probes
        )

    def holds(self, text: str) -> bool:
        new = set(text) - self.good
        for c in new - self.bad:
            (self.good if self.proved(c) else self.bad).add(c)
        return new.isdisjoint(self.bad)


class Splitter:
    """Words of texts, as the library's normaliser and pre-tokenizer have them."""

    def __init__(self, path: str):
        self.tok = load(path)
        self.normal = self.tok.normalizer.normalize_str
        self.words = regex.compile(PATTERN).findall
        self.proof = ClassProof(self.tok.pre_tokenizer, PROBES)
        self.plain, self.plain_words = PlainChars(self.tok), re.compile(PLAIN_WORDS).findall
        self.ascii = PlainChars(self.tok, re.ASCII).holds("".join(map(chr, range(128))))
        self.ascii_words = re.compile(PLAIN_WORDS, re.ASCII).findall
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        ordered = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None

    def __call__(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.part(text)
        out: list[str] = []
        for i, piece in enumerate(self.cut.split(text)):
            out += [piece] if i % 2 else self.part(piece)
        return out

    def part(self, text: str) -> list[str]:
        if self.ascii and text.isascii():
            return self.ascii_words(text.lower())
        if self.plain.holds(text):
            return self.plain_words(text.lower())
        text = self.normal(text)
        if self.proof.holds(text):
            return self.words(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]


_SPLITTERS: dict[str, Splitter] = {}  # one per worker and vocabulary


def splitter(path: str) -> Splitter:
    if path not in _SPLITTERS:
        _SPLITTERS[path] = Splitter(path)
    return _SPLITTERS[path]


def distinct_words(docs: DataFrame, path: str) -> DataFrame:
    """(word, n) over all texts; a text equal to the row before it adds nothing."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen, last = splitter(path), Counter(), None

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for cell in batch.column(0):
                text = cell.as_py()
                if text is not None and text != last:
                    seen.update(split(text))
                last = text
                if len(seen) >= FLUSH_WORDS:
                    yield rows()
        if seen:
            yield rows()

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(words, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Coder:
    """Ids of single words by the library's merges, as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        self.special = splitter(path).special
        self.tokenize = splitter(path).tok.model.tokenize
        self.char = {b: c for c, b in byte_of_char().items()}

    def __call__(self, word: str) -> bytes:
        if word in self.special:
            ids = [self.special[word]]
        else:
            ids = [t.id for t in self.tokenize("".join(map(self.char.__getitem__, word.encode())))]
        return struct.pack(f"<{len(ids)}I", *ids)


def word_table(docs: DataFrame, path: str) -> DataFrame:
    """(word, n, ids) of every distinct word that was counted more than once."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Coder(path)
        for batch in batches:
            found = pa.array([code(w) for w in batch.column(0).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["word", "n", "ids"])

    repeated = distinct_words(docs, path).where("n > 1")
    return written(repeated.mapInArrow(encoded, "word string, n long, ids binary"), "word-table")


def frequent(table: DataFrame, most: int, most_bytes: int = BROADCAST_BYTES, longest: int = LONG_WORD) -> tuple[DataFrame, DataFrame]:
    """The words of the highest counts, cut at a power of two so that at most
    ``most`` of them and ``most_bytes`` are left, none over ``longest`` bytes,
    and the others."""
    power = F.floor(F.log2("n")).cast("int")
    size = F.octet_length("word") + F.octet_length("ids")
    counts = table.where(size <= longest).groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("words"), F.sum(size).alias("bytes"))
    words, held, least = 0, 0, 64
    for r in counts.orderBy(F.desc("p")).collect():
        words, held = words + r.words, held + r.bytes
        if words > most or held > most_bytes:
            break
        least = r.p
    top = (power >= least) & (size <= longest)
    return table.where(top), table.where(~top)


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows in record batches of bounded bytes; the last values are texts or bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row[1:]))
        if size >= BYTES_PER_BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)


class WordIds:
    """The broadcast words, as arrays sorted by hash: a dictionary of a million
    strings would take several times their bytes in every worker. Words met
    lately are held in two dictionaries, a newer and an older, of at most
    CACHE_WORDS together and the words of one text."""

    def __init__(self, words: pa.Table):
        self.h = words.column("h").to_numpy()
        # one chunk each, none for an empty table; not copied, as the broadcast stays in memory
        self.words, self.ids = (c.chunk(0) if c.num_chunks == 1 else c.combine_chunks() for c in (words.column("word"), words.column("ids")))
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def find(self, words: set[str]) -> None:
        """Brings those of ``words`` that the table has into the cache."""
        if len(self.cache) > CACHE_WORDS // 2:
            self.cache, self.older = {}, self.cache
        cache, older, new = self.cache, self.older, []
        for w in words:
            if w not in cache:
                if w in older:
                    cache[w] = older[w]
                else:
                    new.append(w)
        h = np.array([xxh64_intdigest(w.encode(), 42) for w in new], np.uint64).view(np.int64)
        for w, at, own in zip(new, np.searchsorted(self.h, h).tolist(), h.tolist(), strict=True):
            while at < len(self.h) and self.h[at] == own:
                if self.words[at].as_py() == w:
                    self.cache[w] = self.ids[at].as_py()
                    break
                at += 1


def _known(dictionary) -> WordIds:
    """One per worker and broadcast. It lies in the broadcast's value, so that a
    worker that goes on to other work gives its memory back with the broadcast."""
    held = dictionary.value
    if "known" not in held:
        held["known"] = WordIds(held["words"])
    return held["known"]


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def encode(docs: DataFrame, path: str, *, broadcast_words: int = BROADCAST_WORDS, broadcast_bytes: int = BROADCAST_BYTES, id_col: str = "doc_id", then: Step | None = None) -> DataFrame:
    """(id, ids) of every document; ids as little-endian unsigned 32-bit numbers.
    With ``then`` (a ``decoder``) (id, ids, decoded), by the same tasks."""
    spark = docs.sparkSession
    top, others = frequent(word_table(docs, path), broadcast_words, broadcast_bytes)
    hashed = top.select(F.xxhash64("word").alias("h"), "word", "ids").toArrow()  # at most broadcast_words rows and broadcast_bytes, without the hashes
    dictionary = spark.sparkContext.broadcast({"words": hashed.sort_by("h").combine_chunks()})
    complete = others.isEmpty()
    rows = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("ids", T.BinaryType())])
    if then is not None:
        out = out.add("decoded", T.StringType())

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches if then is None else then(batches)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All documents; without the complete table, those that it is enough for."""
        split, table, code = splitter(path), _known(dictionary), Coder(path)

        def coded(text: str) -> bytes | None:
            words = split(text)
            try:
                return b"".join(map(table.cache.__getitem__, words))
            except KeyError:
                table.find(set(words))
            own = table.cache
            if complete:  # the table has every word counted twice: what it lacks stands here alone
                return b"".join([own[w] if w in own else code(w) for w in words])
            return b"".join([own[w] for w in words]) if all(w in own for w in words) else None

        last, own = None, b""
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ids, found, size = [], [], 0
                while at < batch.num_rows and size < BYTES_PER_BATCH:
                    text = batch.column(1)[at].as_py()
                    if text != last:
                        last, own = text, b"" if text is None else coded(text)
                    if own is not None:
                        ids.append(at)
                        found.append(own)
                        size += len(own)
                    at += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(found, pa.binary())], ["id", "ids"])

    done = rows.mapInArrow(lambda batches: finished(plain(batches)), out)
    if complete:
        return done.withColumnRenamed("id", id_col)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, table = splitter(path), _known(dictionary)
        for batch in batches:
            lists = []
            for text in batch.column(1):
                words = set(split(text.as_py()))
                table.find(words)
                lists.append(sorted(w for w in words if w not in table.cache))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.string()))], ["key", "rare"])

    # equal texts ask once: a text stands for itself by its digest
    keyed = rows.where("text is not null").withColumn("key", F.unhex(F.md5("text")))
    asked = keyed.select("key", "text").mapInArrow(rare, "key binary, rare array<string>").where(F.size("rare") > 0)
    asked = written(asked.groupBy("key").agg(F.first("rare").alias("rare")), "bpe-rare")
    wanted = asked.select("key", F.explode("rare").alias("want"))
    answers = wanted.join(others, wanted["want"] == others["word"], "left").groupBy("key").agg(
        F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("word", "ids"))).alias("found")  # at most the words of one text
    )
    answers = written(answers.withColumnRenamed("key", "key2"), "bpe-answers")
    left = keyed.join(answers, keyed["key"] == answers["key2"]).select("id", "text", "found")

    def late(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, table, code = splitter(path), _known(dictionary), Coder(path)

        def told():
            for batch in batches:
                for ident, text, found in zip(*batch.columns, strict=True):
                    more = {f["word"]: f["ids"] for f in found.as_py()}
                    words = split(text.as_py())
                    table.find(set(words))
                    own = table.cache
                    # a word that neither has stands here alone
                    yield ident.as_py(), b"".join([own[w] if w in own else more[w] if w in more else code(w) for w in words])

        return finished(_batches(told(), ["id", "ids"], [kind, pa.binary()]))

    kind = to_arrow_type(out["id"].dataType)
    return done.unionByName(left.mapInArrow(late, out)).withColumnRenamed("id", id_col)


def decoder(spark: SparkSession, path: str) -> Step:
    """The step that gives batches of (id, ids) a column of decoded texts."""
    vocab = load(path).get_vocab(with_added_tokens=True)
    pieces = [""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        pieces[i] = piece
    table = spark.sparkContext.broadcast(pa.array(pieces, pa.string()))  # bounded by the vocabulary

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a few documents at a time: texts are several times as long as ids
            size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.flatnonzero(np.diff(size // (BYTES_PER_BATCH // 2))) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(size)], strict=True):
                part = batch.slice(a, b - a)
                ids = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u4")
                ends = np.concatenate([[0], size[a:b] - (size[a - 1] if a else 0)]) // 4
                lists = pa.LargeListArray.from_arrays(ends, table.value.take(pa.array(ids)))
                texts = pc.binary_join(lists, " ").cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], ["id", "ids", "decoded"])

    return decoded


def decode(coded: DataFrame, path: str, *, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the pieces of the ids in their order, space-joined."""
    rows = coded.select(F.col(id_col).alias("id"), "ids")
    out = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(decoder(coded.sparkSession, path), out).withColumnRenamed("id", id_col)
