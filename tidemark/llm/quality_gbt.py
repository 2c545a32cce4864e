"""Quality rules: base counts, then gradient-boosted trees over document statistics.

The statistics of every whole text are counted in one map over documents and
written as a narrow table. The trees are fitted on a bounded sample of the
labelled rows (``sample_rows``, the smallest hashes of their ids) with
monotonic constraints: more symbols, repeated lines or repeated words never
raise a document's score. All trees are flattened into five numpy node arrays,
and a batch of documents descends all of them at once, one level per step.

Scale: the only shuffle is the join of the labels with the narrow table for
the sample; scoring is a map over it. What is sent to the driver is the sample
(bounded), to the tasks the node arrays (bounded by trees and depth).

Defined cases: a null text has no words (all counts 0, fails the base rules);
labels that are null or not 0/1, or whose document is missing, are not used;
without labels of both kinds every document that passes the base rules is
kept; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import written

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
SAMPLE_ROWS = 20_000
CUTOFF = 0.5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct", "n_upper", "n_digits", "n_marks", "n_chars_seen"]
COUNTS = BASE + MORE
# statistic -> monotonic constraint on the score
FEATURES = {
    "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "mean_word": 0, "words_per_line": 0, "distinct_share": 0, "upper_share": 0, "digit_share": 0, "mark_share": 0, "log_words": 0,
}


def counts_of(raw: bytes, n_chars: int) -> tuple[int, ...]:
    """COUNTS of one text in UTF-8 with ``n_chars`` code points."""
    words = raw.split()  # splits bytes at \x20 and \x09-\x0D
    n, distinct = len(words), set(words)
    in_words = sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if len(distinct) < n:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            times = Counter(windows)
            hit = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[k : k + len(hit)] |= hit
            repeated = int(covered.sum())
    size = len(raw)

    def of(chars: bytes) -> int:
        return size - len(raw.translate(None, chars))

    return (
        n, n_chars - (size - in_words), of(SYMBOLS), len(lines) - len(set(lines)), repeated,
        len(lines), len(distinct), of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), of(b"0123456789"), of(b"!?.,;:"), n_chars,
    )


def features_of(c: dict[str, np.ndarray]) -> np.ndarray:
    """Columns in the order of FEATURES from columns of COUNTS."""
    def share(a, b):
        return np.asarray(a, float) / np.maximum(np.asarray(b, float), 1.0)

    return np.column_stack([
        share(c["n_symbols"], c["word_chars"]), share(c["n_dup_lines"], c["n_lines"]), share(c["n_repeat_words"], c["n_words"]),
        share(c["word_chars"], c["n_words"]), share(c["n_words"], c["n_lines"]), share(c["n_distinct"], c["n_words"]),
        share(c["n_upper"], c["word_chars"]), share(c["n_digits"], c["word_chars"]), share(c["n_marks"], c["word_chars"]),
        np.log1p(np.asarray(c["n_words"], float)),
    ])


@dataclass
class Trees:
    """All trees in flat node arrays; a leaf points to itself."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality of every row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            up = x[rows, self.feature[at]] > self.threshold[at]
            at = np.where(up, self.right[at], self.left[at])
        return self.start + self.value[at].sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], *, trees: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 64, l2: float = 1.0, min_rows: int = 20) -> Trees:
    """Boosted trees for the logistic loss on binned columns. A split whose sides
    break a constraint is not taken, and a constrained split bounds what stands
    below it by the middle of its sides, so the whole score is monotonic."""
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in x.T]
    binned = np.column_stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T, strict=True)])
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(y), start)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []

    def best(rows, g, h, low, high):
        all_g, all_h = g[rows].sum(), h[rows].sum()

        def value(a, b):
            return np.clip(-a / (b + l2), low, high)

        def gain(a, b, v):
            return -(a * v + 0.5 * (b + l2) * v * v)

        own = value(all_g, all_h)
        found = (1e-6, None)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            at = binned[rows, f]
            left = [np.cumsum(np.bincount(at, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], None)]
            sides = [value(left[0], left[1]), value(all_g - left[0], all_h - left[1])]
            won = gain(left[0], left[1], sides[0]) + gain(all_g - left[0], all_h - left[1], sides[1]) - gain(all_g, all_h, own)
            won[(left[2] < min_rows) | (len(rows) - left[2] < min_rows) | (monotone[f] * (sides[1] - sides[0]) < 0)] = 0
            k = int(won.argmax())
            if won[k] > found[0]:
                found = (won[k], (f, k, sides[0][k], sides[1][k]))
        return own, found[1]

    def grow(rows, g, h, low, high, left_depth) -> int:
        me = len(nodes)
        own, split = best(rows, g, h, low, high)
        nodes.append([0, 0.0, me, me, rate * own])
        if split is None or not left_depth:
            total[rows] += rate * own
            return me
        f, k, lower, upper = split
        mid, sign = (lower + upper) / 2, monotone[f]
        go = binned[rows, f] > k
        a = grow(rows[~go], g, h, mid if sign < 0 else low, mid if sign > 0 else high, left_depth - 1)
        b = grow(rows[go], g, h, mid if sign > 0 else low, mid if sign < 0 else high, left_depth - 1)
        nodes[me][:4] = [f, edges[f][k], a, b]
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), -np.inf, np.inf, depth))
    flat = np.array(nodes, float)
    whole = [flat[:, i].astype(np.int64) for i in (0, 2, 3)]
    return Trees(start, np.array(roots), whole[0], flat[:, 1], whole[1], whole[2], flat[:, 4], depth)


def statistics(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, COUNTS) of every whole text."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            chars = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            raws = texts.cast(pa.binary()).to_pylist()
            rows = [counts_of(r or b"", c) for r, c in zip(raws, chars, strict=True)]
            cols = zip(*rows, strict=True) if rows else [[]] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols]], ["id", *COUNTS])

    rows = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    fields = [T.StructField("id", rows.schema["id"].dataType), *[T.StructField(c, T.LongType()) for c in COUNTS]]
    return rows.mapInArrow(counted, T.StructType(fields))


def train(stats: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
          label_col: str = "quality") -> Trees | None:
    """Trees fitted on at most ``sample_rows`` labelled rows; None without both labels."""
    told = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    rows = told.join(stats, F.col("label_id") == F.col("id")).select("label_id", "label", *COUNTS)
    order = [F.xxhash64(F.col("label_id").cast("string")), F.col("label_id"), F.col("label"), *[F.col(c) for c in COUNTS]]
    sample = rows.orderBy(*order).limit(sample_rows).toPandas()
    if sample["label"].nunique() < 2:
        return None
    return fit(features_of({c: sample[c].to_numpy() for c in COUNTS}), sample["label"].to_numpy(float), list(FEATURES.values()))


def quality(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS, cutoff: float = CUTOFF,
            id_col: str = "doc_id") -> DataFrame:
    """(id, BASE, base_failed, kept, score) of every document; ``score`` is the
    trees' probability of good quality (null without labels)."""
    stats = written(statistics(docs, id_col), "quality-stats")
    model = train(stats, labels, sample_rows=sample_rows, id_col=id_col)
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    if model is None:
        scored = stats.select("id", *BASE, F.lit(None).cast("double").alias("score"))
    else:
        kind = stats.schema["id"].dataType

        def scored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cols = {c: batch.column(i + 1).to_numpy(zero_copy_only=False) for i, c in enumerate(COUNTS)}
                p = 1 / (1 + np.exp(-model.score(features_of(cols))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[batch.column(i + 1) for i in range(len(BASE))], pa.array(p, pa.float64())],
                    ["id", *BASE, "score"],
                )

        fields = [T.StructField("id", kind), *[T.StructField(c, T.LongType()) for c in BASE], T.StructField("score", T.DoubleType())]
        scored = stats.mapInArrow(scored_rows, T.StructType(fields))
    verdict = ~F.col("base_failed") & F.coalesce(F.col("score") >= cutoff, F.lit(True))
    return scored.withColumn("base_failed", failed).withColumn("kept", verdict).select(
        F.col("id").alias(id_col), *BASE, "base_failed", "kept", "score"
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS, cutoff: float = CUTOFF, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the rules keep. Texts are read twice (for the
    sample's statistics and for the verdicts) and not shuffled."""
    model = train(written(statistics(docs, id_col), "quality-stats"), labels, sample_rows=sample_rows, id_col=id_col)
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            chars = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            rows = [counts_of(r or b"", c) for r, c in zip(texts.cast(pa.binary()).to_pylist(), chars, strict=True)]
            if rows:
                c = dict(zip(COUNTS, np.array(rows).T, strict=True))
                keep = (c["n_words"] >= MIN_WORDS) & (100 * c["n_repeat_words"] <= 50 * c["n_words"])
                if model is not None:
                    keep &= 1 / (1 + np.exp(-model.score(features_of(c)))) >= cutoff
                yield batch.filter(pa.array(keep))

    return docs.mapInArrow(kept, docs.schema)
