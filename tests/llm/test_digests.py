"""Base counts of the quality rules and chat digests against plain Python, and
input columns whose names clash with those the operators make."""

import random
import re
from collections import Counter
from hashlib import sha256

from pyspark.sql import functions as F

from tidemark.llm import chat_trees, quality_gbt, secret_battery, simhash_tiles
from tidemark.llm.queries import QUERIES

RNG = random.Random(23)
WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_base_counts(spark):
    vocabulary = ["ab", "é", "#x", "a|b", "𝒳y", " ", "\x85", "\x1f", "c", "d" * 30]
    texts = [None, "", " \n\t", "a\x0bb\x0cc\rd", "x\n\nx\n x\nx \n\n", "a a a a", "a b c a b c", "w " * 50, "w " * 49, " ".join(["x"] * 60)]
    texts += ["".join(w + RNG.choice([" ", "\n", "  ", "\t", "\r\n"]) for w in RNG.choices(vocabulary, k=RNG.randint(1, 120))) for _ in range(60)]
    texts += [" ".join(f"w{RNG.randint(0, 400)}" for _ in range(RNG.randint(45, 9000))) for _ in range(10)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_gbt.quality(rows, none).collect()}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert {i: tuple(r[n] for n in names) for i, r in got.items()} == {i: plain_counts(t) for i, t in enumerate(texts)}
    assert all(r.kept == (not r.base_failed) for r in got.values())


def hexed(text):
    return sha256(text.encode()).hexdigest()


def test_chat_digests(spark, tmp_dir):
    parts = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "\n", "é", "word ", "<", "["]
    rows = []
    for conv in range(40):
        for turn in range(RNG.choice([1, 2, 3, 7, 18])):
            role = RNG.choice(["user", "assistant", "system"])
            rows.append((conv, turn, role, RNG.choice([None, "", "".join(RNG.choices(parts, k=RNG.randint(1, 30)))])))
    RNG.shuffle(rows)
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    told = "</s>[INST] ok [/INST]"
    want = {}
    for conv in range(40):
        want[conv] = [(r, t or "") for _, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: x[1])]
    want[-7] = [("user", told), ("assistant", told)]
    got = {r.conv_id: r for r in QUERIES["op7_chat_format"](spark, tmp_dir).collect()}
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hexed("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hexed(loss))
        assert r.formatted_chars == len(chat_trees.format_turns(turns)[0])


def test_clashing_columns_keep_their_values(spark):
    names = ["_row", "_text_hash", "_secret_base", "_secret_spans", "row", "place", "tie", "id", "base", "spans", "fp", "a.b"]
    texts = ["one two three four", "ONE two three four", None, "x password=hunter2hunter2", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = rows.select("doc_id", "text", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    kept = simhash_tiles.drop_near_duplicates(rows, shingle=3, radius=2)
    masked = secret_battery.redact(rows)
    assert kept.schema == rows.schema and masked.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    for r in [*kept.collect(), *masked.collect()]:
        assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names]
    assert [r.text for r in masked.orderBy("doc_id").collect()] == [*texts[:3], "x [SECRET]", ""]
