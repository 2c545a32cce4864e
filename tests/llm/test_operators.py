"""Near-duplicates, repeated strings, top-k, chat trees, quality rules and the
pipeline on small fixtures, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat_trees, nra_topk, quality_gbt, simhash_tiles, suffix_buckets

RNG = random.Random(11)
WORDS = ["".join(RNG.choices("abcdefghij", k=RNG.randint(2, 7))) for _ in range(300)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


BASE = [prose(60) for _ in range(25)]
TEXTS = [None, None, "", " \n", "One", "one", "ONE two", *BASE, BASE[0], BASE[0].upper(), BASE[1] + " x", BASE[2].replace(" ", "\n", 3),
         *[BASE[3] + f" tail{i}" for i in range(20)], "a" * 3000, prose(10) + BASE[4][40:330] + prose(10), prose(8) + BASE[5][10:215], "é" * 150, prose(4000)]
DOCS = "doc_id long, text string, fp string, size int"


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], DOCS).repartition(3)


def test_near_duplicates_against_all_pairs(spark):
    got = {r.doc_id: r for r in simhash_tiles.near_duplicates(docs(spark), tile=4).collect()}
    fps = np.array([simhash_tiles.fingerprint((t or "").encode()) for t in TEXTS], np.uint64)
    assert [got[i].fingerprint for i in range(len(TEXTS))] == [f"{f:016x}" for f in fps.tolist()]
    low = list(range(len(TEXTS)))
    for _ in TEXTS:  # least id over links until nothing changes
        new = [min(low[j] for j in np.flatnonzero(np.bitwise_count(fps ^ f) <= 2)) for f in fps]
        if new == low:
            break
        low = new
    assert [got[i].component_id for i in range(len(TEXTS))] == low
    kept = simhash_tiles.drop_near_duplicates(docs(spark).unionByName(docs(spark).where("doc_id < 9")))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(low)) and kept.columns == ["doc_id", "text", "fp", "size"]
    assert simhash_tiles.near_duplicates(docs(spark, [])).collect() == []


@pytest.mark.parametrize("length,q,cell", [(200, 50, 32), (40, 10, 8)])
def test_repeated_strings_against_all_positions(spark, length, q, cell):
    raws = [(t or "").encode() for t in TEXTS]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    got = {r.doc_id: r for r in suffix_buckets.remove_repeats(docs(spark), length=length, q=q, cell=cell).collect()}
    for i, raw in enumerate(raws):
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - length + 1):
            if seen[raw[at : at + length]] > 1:
                gone[at : at + length] = True
        assert bytes(got[i].kept) == np.frombuffer(raw, np.uint8)[~gone].tobytes(), i
        assert sum(s["end"] - s["start"] for s in got[i].spans) == gone.sum()
    assert suffix_buckets.remove_repeats(docs(spark, [])).collect() == []


def test_topk_against_all_scores(spark):
    rng = np.random.default_rng(3)
    vecs = [(i, [float(x) for x in rng.normal(size=6).round(2)]) for i in range(230)]
    vecs += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (None, [1.0]), (304, [1.0]), (305, []), (5, vecs[5][1])]
    vecs += [(400 + i, vecs[0][1]) for i in range(30)]
    rows = spark.createDataFrame([(*v, 1.0, 7) for v in vecs], "vec_id long, embedding array<float>, score double, qb int")
    got = nra_topk.top_k(rows, F.col("id") % 20 == 0, block=32, query_block=4)
    whole = {}
    for i, v in vecs:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = np.array([*np.floor(1024 * np.array(v, np.float32).astype(float)), *[0] * (6 - len(v))], np.int64)
    want = set()
    for i in (i for i in whole if i % 20 == 0):
        best = sorted((-int(whole[i] @ w), j) for j, w in whole.items() if j != i)[:10]
        want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == want
    assert nra_topk.top_k(rows.limit(0), F.col("id") % 20 == 0).collect() == []


def test_topk_keeps_rows_that_share_an_id(spark):
    rng = np.random.default_rng(4)
    vecs = [(i % 60, [float(x) for x in rng.normal(size=5).round(2)]) for i in range(150)]
    rows = spark.createDataFrame([*vecs, vecs[0], vecs[7]], "vec_id long, embedding array<float>")
    got = nra_topk.top_k(rows, F.col("id") % 20 == 0, block=32, query_block=4)
    whole = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in vecs]
    want = Counter()
    for n, (i, v) in enumerate(whole):
        if i % 20 == 0:
            best = sorted((-int(v @ w), j) for m, (j, w) in enumerate(whole) if m != n)[:10]
            want.update((i, r + 1, j, -s) for r, (s, j) in enumerate(best))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_reply_trees(spark):
    nodes = [("t", 1, None, "user", "hi </s>", 0.0), ("t", 2, 1, "assistant", "[INST] \\ a\\l", 1.0), ("t", 3, 1, "assistant", "b", 3.0), ("t", 4, 2, "user", None, 9.0),
             ("u", 1, 9, None, "orphan", None), ("c", 1, 2, "user", "circle", 0.0), ("c", 2, 1, "user", "circle", 0.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    got = chat_trees.format_trees(df, top=None).orderBy("tree", "rank").collect()
    assert [(r.tree, r.leaf, r["rank"]) for r in got] == [("t", 4, 1), ("t", 3, 2), ("u", 1, 1)]
    assert chat_trees.read_turns(got[0].formatted) == [("user", "hi </s>"), ("assistant", "[INST] \\ a\\l"), ("user", "")]
    a, b = got[0].mask[0]
    assert chat_trees.unescape(got[0].formatted[a:b]) == "[INST] \\ a\\l"
    turns = [(RNG.choice(["user", "assistant", ""]), "".join(RNG.choices(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "x\n"], k=8))) for _ in range(300)]
    assert chat_trees.read_turns(chat_trees.format_turns(turns)[0]) == turns
    assert chat_trees.format_trees(df.limit(0)).collect() == []


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(3000) < 0.1)).astype(float)
    model = quality_gbt.fit(x[:2000], y[:2000], [-1, 0, 0])
    assert ((model.score(x[2000:]) > 0) == (x[2000:, 0] < 0.5)).mean() > 0.95
    line = np.column_stack([np.linspace(0, 1, 200), np.full(200, 0.3), np.full(200, 0.6)])
    assert (np.diff(model.score(line)) <= 1e-12).all()


def labelled(spark):
    good = [prose(80) for _ in range(150)]
    bad = [re.sub(r"(\w+)", r"\1###", prose(80)) for _ in range(60)]
    texts = [*good, *bad, None, "", "short", "same words again " * 40, good[0], good[1] + " password=hunter2hunter2"]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return rows, [(i, int(i < 150), 0) for i in range(210)] + [(999, 1, 0), (3, None, 0)], bad


def test_quality_rules(spark):
    rows, labels, bad = labelled(spark)
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_gbt.quality(d, told).collect()}
    assert all(got[i].kept for i in range(150)) and not any(got[i].kept for i in range(150, 214))
    assert all(got[i].base_failed for i in range(210, 214)) and got[213].n_repeat_words == 120
    kept = quality_gbt.keep_good(d, told)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept} and kept.columns == d.columns
    assert all(r.kept != r.base_failed for r in quality_gbt.quality(d, told.limit(0)).collect())


def test_pipeline_stages(spark, tmp_dir):
    rows, labels, _ = labelled(spark)
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs_now, seen = spark.read.parquet(f"{tmp_dir}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = f"{tmp_dir}/{i}"
        stage(spark, docs_now, tmp_dir).write.parquet(out)
        docs_now = spark.read.parquet(out)
        assert docs_now.columns == d.columns
        seen[name] = {r.doc_id: r for r in docs_now.collect()}
    assert set(seen["quality_rules"]) == {*range(150), 214, 215}
    assert 214 not in seen["near_dedup"]  # the copy of document 0
    assert "[SECRET]" in seen["secret_scan"].get(215, seen["secret_scan"][0]).text or 215 not in seen["near_dedup"]
    words = sum(len(r.text.split()) for r in seen["secret_scan"].values())
    mixed = sum(len(r.text.split()) for r in docs_now.collect())
    assert abs(mixed - 1.5 * words) < 4 * 90
    assert corpus_pipeline.run(spark, tmp_dir).count() == docs_now.count()
