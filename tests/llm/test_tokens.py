"""Token counts and the BPE codec against the tokenizers library."""

import gc
import hashlib
import weakref
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import token_counts, word_table_bpe
from tidemark.llm.queries import bpe_digests, tokenizer_path

TEXTS = [
    None, "", " ", "\n\n  \t x", "Hello world's 123 it's IT'S", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|startoftext|>c<|endoftex", "naïve Ünïcödé ß İ ǅ ﬁ",
    "日本語 の テキスト ١٢٣ Ⅷ ½", "\u0085  x​\x1c\x1d \x00", "é å 한국어 각", "🙂👩‍👩‍👧 \U0001e921\U00011f02 ͸\U000323b0 Ᲊᲊ",
    "foo   bar\r\n\tbaz  ", "x" * 50_000, "tionthble " * 5_000, "!!! ... --- ###", "don't can't we'll they're I'd I'm you've 'S 'T", "'' 's 'sx '",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 5, b"z") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], None, None, None), (None, "null id", "y", 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n_tokens int, ids binary").repartition(3)


def test_counts(docs):
    path = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = token_counts.count_tokens(docs, path, limit=512).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "null id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        n = len(tok.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 512), text[:50]
    assert token_counts.count_tokens(docs.limit(0), path).collect() == []


def test_whole_tokens_are_proved():
    path = tokenizer_path("byte_bpe_50k.json")
    tok, proved = Tokenizer.from_file(path), token_counts.prove_whole_tokens(path)
    assert len(proved) > 40_000 and " the" in proved and "<|endoftext|>" not in proved
    assert all(len(tok.encode(s).ids) == 1 for s in list(proved)[:2000])


@pytest.mark.parametrize("bound", [1_500_000, 4])
def test_codec(docs, bound):
    """With a bound of four words nearly every document takes the join's way."""
    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = word_table_bpe.decode(word_table_bpe.encode(docs, path, broadcast_words=bound), path)
    rows = got.withColumn("sha", F.sha2("ids", 256)).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = "null id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids, text[:50]
        assert r.sha == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded == tok.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("bound", [1_500_000, 4])
def test_tasks_that_encode_also_decode(docs, bound):
    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = word_table_bpe.encode(docs, path, broadcast_words=bound, then=word_table_bpe.decoder(docs.sparkSession, path)).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        ids = tok.encode("null id" if r.doc_id is None else TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == tok.decode(ids, skip_special_tokens=False)


def test_a_digest_task_has_one_python_worker(docs):
    """Each Python operator in a task holds a worker of its own."""
    plan = bpe_digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_word_table_goes_with_its_broadcast():
    words = pa.table({"h": pa.array([], pa.int64()), "word": pa.array([], pa.string()), "ids": pa.array([], pa.binary())})
    broadcast = SimpleNamespace(value={"key": 1, "words": words})
    assert word_table_bpe._known(broadcast) is word_table_bpe._known(broadcast)
    left = weakref.ref(word_table_bpe._known(broadcast))
    del broadcast
    gc.collect()
    assert left() is None


def test_broadcast_words_are_bounded_by_bytes(spark):
    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = [f"{'ab' * 3000} common words {'日本' * 500}", "common words stand here", "here common " + "xy" * 400, "once " + "xy" * 400] * 2
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = word_table_bpe.word_table(rows, path)
    whole = {r.word: len(r.word.encode()) + len(r.ids) for r in table.collect()}
    assert max(whole.values()) > word_table_bpe.LONG_WORD
    for most in (word_table_bpe.BROADCAST_BYTES, 100, 30):
        top, others = (part.collect() for part in word_table_bpe.frequent(table, 1_500_000, most))
        assert sorted(r.word for r in top + others) == sorted(whole)
        assert sum(whole[r.word] for r in top) <= most and all(whole[r.word] <= word_table_bpe.LONG_WORD for r in top)
        assert most < 100 or "common" in {r.word for r in top}
        got = word_table_bpe.encode(rows, path, broadcast_bytes=most).collect()
        assert sorted(r.doc_id for r in got) == list(range(len(texts)))
        for r in got:
            assert np.frombuffer(r.ids, "<u4").tolist() == tok.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_codec_empty(docs):
    path = tokenizer_path("word_bpe_49k.json")
    assert word_table_bpe.encode(docs.limit(0), path).collect() == []


def test_every_code_point_splits_as_the_library_does():
    """Each code point between letters, digits and signs, alone and in long texts."""
    path = tokenizer_path("word_bpe_49k.json")
    split = word_table_bpe.Splitter(path)
    tok = split.tok
    marks = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"Aß{c}é{c}{c}1{c}'s {c}É_{c}" for c in marks if ord(c) < 0x3000 or ord(c) % 16 == 0]
    texts += ["ΑΣ ΟΔΟΣ", "é É ẹ́", "".join(marks[:0x2FF]), "".join(marks[0x370:0x483]), "".join(marks[0x4E00:0x5200])]
    for text in texts:
        normal = tok.normalizer.normalize_str(text)
        assert split.part(text) == [normal[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(normal)], text[:20]
    assert split.plain.holds("éÄяÉ中 ß") and not split.plain.holds("ΑΣ") and not split.plain.holds("e\u0301")


def test_equal_neighbours_are_worked_once(spark):
    path = tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = ["only here alone"] * 3 + [None, None, "", "only here alone", "Zwölf Größen"] + ["Zwölf Größen"] * 2
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert {r.word: r.n for r in word_table_bpe.distinct_words(rows, path).collect()} == {"only": 2, "here": 2, "alone": 2, "zwölf": 1, "größen": 1}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in word_table_bpe.encode(rows, path).collect()}
    assert got == {i: tok.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
