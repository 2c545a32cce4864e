"""Token counts of a byte-level BPE vocabulary by the whole-token shortcut.

Offline, once per vocabulary: for every vocabulary string it is proved (the
library encodes the string alone) that it is one pre-token and encodes alone
as one token. A pre-token with such a string counts 1 without any merge; only
the rest is merged, each distinct pre-token once per worker's cache.

Texts are split with the same pattern as the library's pre-tokenizer. The two
regex engines may hold different Unicode tables, so every code point that
occurs is proved first: the library must sort it into the class (letter,
number, space, other) that this module's pattern does. A text with a code
point that fails the proof is given to the library whole.

Special strings inside texts are single tokens, as the library's default has
it. Work is a map over documents: no shuffle, bounded by the longest text; the
cache holds at most ``CACHE_LIMIT`` strings.

Defined cases: a null text is empty (0 bytes, 0 tokens); repeated rows each
give a row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE_LIMIT = 500_000
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# one probe per class: a code point of the class joins both neighbours to one piece
PROBES = (("x", r"\p{L}"), ("1", r"\p{N}"), ("?", r"[^\s\p{L}\p{N}]"))


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    follow from code point 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def prove_whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that are one pre-token and encode alone as one token."""
    tok, back, proved = load(path), byte_of_char(), set()
    split = regex.compile(PATTERN)
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    for piece, ident in tok.get_vocab(with_added_tokens=False).items():
        try:
            s = bytes(back[c] for c in piece).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: never a pre-token
        if s and s not in special and split.findall(s) == [s] and tok.encode(s, add_special_tokens=False).ids == [ident]:
            proved.add(s)
    return frozenset(proved)


class ClassProof:
    """Proves code points: the library's class against the pattern's."""

    def __init__(self, pre_tokenizer, probes=PROBES):
        self.pre, self.probes = pre_tokenizer, [(x, regex.compile(c)) for x, c in probes]
        self.good: set[str] = set()
        self.bad: set[str] = set()

    def holds(self, text: str) -> bool:
        seen = set(text)
        for c in seen - self.good - self.bad:
            same = all(
                (len(self.pre.pre_tokenize_str(x + c + x)) == 1) == bool(own.fullmatch(c)) for x, own in self.probes
            )
            (self.good if same else self.bad).add(c)
        return not self.bad or self.bad.isdisjoint(seen)


class Counter:
    """Tokens of texts, by whole tokens first."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.tok, self.whole = load(path), whole
        self.split = regex.compile(PATTERN)
        self.proof = ClassProof(self.tok.pre_tokenizer)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.cost = dict.fromkeys(whole, 1)

    def merge(self, pieces: set[str]) -> None:
        if len(self.cost) > CACHE_LIMIT:
            self.cost = dict.fromkeys(self.whole, 1)
        new = [p for p in pieces if p not in self.cost]  # the cache is far larger than a text
        for p, e in zip(new, self.tok.encode_batch(new, add_special_tokens=False), strict=True):
            self.cost[p] = len(e.ids)

    def count(self, text: str) -> int:
        if not self.proof.holds(text):
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        specials, parts = 0, [text]
        if self.cut is not None and any(s in text for s in self.special):
            parts = self.cut.split(text)
            specials = len(parts) - 1
        total = specials
        for part in parts:
            pieces = self.split.findall(part)
            try:
                total += sum(map(self.cost.__getitem__, pieces))
            except KeyError:
                self.merge(set(pieces))
                total += sum(self.cost[p] for p in pieces)
        return total


_COUNTERS: dict[str, Counter] = {}  # one per worker and vocabulary


def count_tokens(docs: DataFrame, path: str, *, limit: int = 512, id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every document."""
    spark = docs.sparkSession
    whole = spark.sparkContext.broadcast(prove_whole_tokens(path))  # bounded by the vocabulary

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path, whole.value)
        counter = _COUNTERS[path]
        for batch in batches:
            texts = batch.column(1)
            n = [counter.count(t) if t else 0 for t in texts.to_pylist()]
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    out = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])
    counts = rows.mapInArrow(counted, out)
    return counts.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
