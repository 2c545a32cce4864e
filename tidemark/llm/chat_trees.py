"""Chat formatting of reply trees.

Nodes (tree, node, parent, role, text, score) form trees of replies. Iterative
self-joins enumerate root-to-leaf paths: pointers to parents are doubled (each
round joins the table of 2^k-step ancestors with itself), which gives every
node's depth and path score in a logarithmic number of rounds. Leaves are the
branches; they are ranked by the mean score of their path, ties to the smaller
leaf. The chosen leaves' paths are then spread out by the same pointers, from
the longest step to the shortest, so that a path of any length takes as many
joins as its length has binary digits. All joins are on (tree, node): a tree
with a third of all nodes is spread out like any other.

Each chosen path becomes one conversation: per turn
``<s>[INST]role[/INST]text</s>``. Control strings inside roles and texts are
escaped reversibly: their first character becomes ``\\l`` (for ``<``) or
``\\b`` (for ``[``), and a backslash becomes two. The loss mask is the list of
code-point ranges of the formatted assistant texts.

Defined cases: null roles and texts are empty; a null score counts 0; a parent
that is null or missing makes a root; a node whose parents run in a circle has
no root and is on no path; rows that repeat a (tree, node) are told apart by
the caller (``linear`` numbers them); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import written

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
ASSISTANT = "assistant"
_ESCAPE = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_TO = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {"\\": "\\", "l": "<", "b": "["}
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: _TO[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text, flags=re.DOTALL)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text and its loss mask."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST]{escape(role)}[/INST]", escape(text)
        if role == ASSISTANT:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "</s>"]
        at += len(head) + len(body) + 4
    return "".join(out), mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``format_turns`` was given."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def linear(rows: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """Conversations by turn as trees without branches; equal turns by role and text."""
    order = W.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    return rows.select(F.col(id_col).alias("tree"), "turn", "role", "text").select(
        "tree", F.row_number().over(order).cast("long").alias("node"), "role", "text"
    ).select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _same_tree(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def _ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of (tree, node, up, steps, total): table k has the nodes with an
    ancestor 2^(k-1) steps up and the one 2^k steps up, or null past the root,
    with the steps and scores of the nodes passed. And the nodes that have
    reached their root; only the others go into the next round."""
    parents = nodes.select(F.col("tree").alias("t2"), F.col("node").alias("n2"))
    first = nodes.join(parents, _same_tree("tree", "t2") & (F.col("parent") == F.col("n2")), "left").select(
        "tree", "node", F.col("n2").alias("up"), F.lit(1).cast("long").alias("steps"), F.coalesce("score", F.lit(0.0)).alias("total")
    )
    tables = [written(first, "chat-up-0")]
    ended = tables[0].where("up is null")
    rounds = max(1, nodes.count()).bit_length()  # a path is no longer than the table
    while len(tables) <= rounds and not tables[-1].where("up is not null").isEmpty():
        now = tables[-1].where("up is not null")
        above = now.unionByName(ended).select(
            F.col("tree").alias("t2"), F.col("node").alias("n2"), F.col("up").alias("up2"), F.col("steps").alias("s2"), F.col("total").alias("w2")
        )
        double = now.join(above, _same_tree("tree", "t2") & (F.col("up") == F.col("n2"))).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("steps") + F.col("s2")).alias("steps"), (F.col("total") + F.col("w2")).alias("total")
        )
        tables.append(written(double, f"chat-up-{len(tables)}"))
        ended = ended.unionByName(tables[-1].where("up is null"))
    return tables, ended


def paths(nodes: DataFrame, top: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, score, node, place) of the ``top`` best branches of each
    tree (None: all); place counts from the leaf."""
    nodes = nodes.select("tree", "node", "parent", "score")
    tables, rooted = _ancestors(nodes)  # the rest runs in a circle
    parents = nodes.where("parent is not null").select(F.col("tree").alias("t2"), F.col("parent").alias("n2")).distinct()
    leaves = rooted.join(parents, _same_tree("tree", "t2") & (F.col("node") == F.col("n2")), "left_anti").select(
        "tree", F.col("node").alias("leaf"), "steps", (F.col("total") / F.col("steps")).alias("score")
    )
    order = W.partitionBy("tree").orderBy(F.desc("score"), F.asc("leaf"))
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    ranked = ranked.where(F.col("rank") <= top) if top else ranked
    found = ranked.select("tree", "leaf", "rank", "score", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("place"))
    for k in reversed(range(len(tables) - 1)):
        up = tables[k].where("up is not null").select(F.col("tree").alias("t2"), F.col("node").alias("n2"), "up")
        found = written(found, f"chat-paths-{k}")
        more = found.join(up, _same_tree("tree", "t2") & (F.col("node") == F.col("n2"))).select(
            "tree", "leaf", "rank", "score", F.col("up").alias("node"), (F.col("place") + (1 << k)).alias("place")
        )
        found = found.unionByName(more)
    return found


def format_trees(nodes: DataFrame, top: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, score, formatted, mask) of every chosen path; a
    conversation is one row, so its turns meet in one task."""
    nodes = written(nodes.select("tree", "node", "parent", "role", "text", "score"), "chat-nodes")
    chosen = written(paths(nodes, top), "chat-paths")
    texts = nodes.select(
        F.col("tree").alias("t2"), F.col("node").alias("n2"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = (
        chosen.join(texts, _same_tree("tree", "t2") & (F.col("node") == F.col("n2")))
        .groupBy("tree", "leaf", "rank", "score")
        .agg(F.collect_list(F.struct("place", "role", "text")).alias("turns"))
    )

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for turns_of in batch.column(4):
                ordered = sorted(turns_of.as_py(), key=lambda t: -t["place"])
                told.append(format_turns([(t["role"], t["text"]) for t in ordered]))
            masks = [[{"start": a, "end": b} for a, b in m] for _, m in told]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([t for t, _ in told], pa.string()), pa.array(masks, kind)],
                ["tree", "leaf", "rank", "score", "formatted", "mask"],
            )

    out = T.StructType([*turns.schema.fields[:4], T.StructField("formatted", T.StringType()),
                        T.StructField("mask", T._parse_datatype_string("array<struct<start:bigint,end:bigint>>"))])
    return turns.mapInArrow(formatted, out)


def digests(conversations: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """What the formatted conversations hold, read back from text and mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = read_turns(text)
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((len(turns), sha256(whole.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    rows = conversations.select("tree", "formatted", "mask")
    out = T.StructType([rows.schema["tree"], *[T.StructField(n, t) for n, t in (
        ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()),
        ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()))]])
    return rows.mapInArrow(read, out).withColumnRenamed("tree", id_col)
