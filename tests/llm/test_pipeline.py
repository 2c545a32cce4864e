"""Every stage of the pipeline after the quality rules, against plain Python on
the rows that the stage before wrote."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_mix_url import plain_targets
from tests.llm.test_operators import labelled, prose
from tests.llm.test_secrets import plain_base
from tidemark.llm import simhash_tiles
from tidemark.llm.queries import tokenizer_path

RANDOM = "".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=64))
SECRETS = ["password=hunter2hunter2", "AKIA" + "Z9" * 8, "token: " + "0a" * 20, RANDOM]


def plain_kept(rows):
    ids = [r.doc_id for r in rows]
    fps = np.array([simhash_tiles.fingerprint((r.text or "").encode()) for r in rows], np.uint64)
    low = list(ids)
    for _ in rows:  # least id over links until nothing changes
        new = [min(low[j] for j in np.flatnonzero(np.bitwise_count(fps ^ f) <= 2)) for f in fps]
        if new == low:
            break
        low = new
    return sorted(set(low))


def plain_masked(text):
    spans = [tuple(map(int, x.split(":")[1:])) for x in plain_base(text).split(",") if x]
    spans += [m.span() for m in re.finditer(RANDOM, text)]
    out, at = "", 0
    for a, b in sorted(spans):
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def plain_copies(rows):
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size[r.doc_id]

    def key(r):
        u = (int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / (sum(c not in "#*$%&|<>" for c in r.text) / len(r.text)) ** 2

    out = {}
    for source, target in plain_targets(sizes).items():
        epochs = int(target // sizes[source])
        rest, done = target - epochs * sizes[source], 0
        for r in sorted((r for r in rows if r.source == source), key=key):
            n = size[r.doc_id]
            out[r.doc_id] = epochs + int(rest > 0 and 2 * done + n <= 2 * rest)
            done += n
    return out


def test_stages_against_plain_python(spark, tmp_dir):
    rows, labels, _ = labelled(spark)
    for i, secret in enumerate(SECRETS):
        text = f"{prose(50)} {secret} {prose(40)}"
        rows.append((300 + i, text, "en", f"s{i % 4}", len(text)))
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    now, seen = spark.read.parquet(f"{tmp_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, tmp_dir).write.parquet(f"{tmp_dir}/{name}")
        now = spark.read.parquet(f"{tmp_dir}/{name}")
        seen[name] = now.collect()

    good, kept, masked, mixed = (seen[n] for n in ("quality_rules", "near_dedup", "secret_scan", "source_mix"))
    assert {r.doc_id for r in good} >= set(range(300, 304))
    assert sorted(r.doc_id for r in kept) == plain_kept(good)
    assert {r.doc_id for r in kept} >= set(range(300, 304))
    assert {tuple(r) for r in kept} <= {tuple(r) for r in good}
    want = [(r.doc_id, plain_masked(r.text), r.lang, r.source) for r in kept]
    assert sorted((r.doc_id, r.text, r.lang, r.source) for r in masked) == sorted(want)
    assert all(("[SECRET]" in r.text) == (r.doc_id >= 215) and r.n_chars == len(r.text) for r in masked)
    copies = plain_copies(masked)
    assert Counter(tuple(r) for r in mixed) == Counter({tuple(r): copies[r.doc_id] for r in masked if copies[r.doc_id]})
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    told = []
    for r in mixed:
        ids = tok.encode(r.text, add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        told.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in seen["bpe_codec"]) == sorted(told)
