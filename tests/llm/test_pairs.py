"""Hard negatives, the n-gram Jaccard join and the token alignment, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import four_russians, overlap_search, queries, token_spans
from tidemark.llm.token_counts import byte_of_char

# --- hard negatives ---------------------------------------------------------------


def brute_negatives(rows, every, scale=256):
    kept = [(i, label, [int(np.floor(scale * float(x))) for x in v]) for i, label, v in rows
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(len(v) for *_, v in kept)
    m = np.array([v + [0] * (width - len(v)) for *_, v in kept], np.int64)
    out = Counter()
    for a, (i, label, _) in enumerate(kept):
        if i is None or i % every:
            continue
        s = (m @ m[a]).tolist()

        def place(j):
            return -s[j], kept[j][0] is None, kept[j][0] or 0

        for p in sorted((j for j in range(len(kept)) if j != a and kept[j][1] == label), key=place)[:5]:
            fit = sorted((j for j in range(len(kept)) if kept[j][1] != label and 50 * s[p] <= 100 * s[j] <= 95 * s[p]), key=place)[:3]
            out.update((i, kept[p][0], r + 1, kept[j][0], s[p], s[j]) for r, j in enumerate(fit))
    return out


def test_hard_negatives_against_all_scores(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(rng.integers(4)), [float(x) for x in rng.normal(size=11).round(2) + 0.3]) for i in range(240)]
    rows += [(None, 1, rows[0][2]), (5, 2, [1.0, 2.0]), (6, None, [1.0]), (7, 1, None), (8, 1, [None]), (9, 1, [float("inf")]), (10, 3, [])]
    rows += [(400 + i, 1, rows[20][2]) for i in range(30)] + [rows[20]]  # ties and repeated rows
    # columns named as the operator's own
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, label int, embedding array<float>, row long, packed string, of double")
    got = four_russians.hard_negatives(df, F.col("id") % 20 == 0, block=32, query_block=4)
    assert Counter(tuple(r) for r in got.collect()) == brute_negatives([(r.vec_id, r.label, r.embedding) for r in df.collect()], 20)
    assert four_russians.hard_negatives(df.limit(0), F.col("id") % 20 == 0).collect() == []


def test_subset_sums_give_inner_products():
    rng = np.random.default_rng(1)
    x, a = rng.integers(-300, 300, (50, 19)), rng.integers(-300, 300, (7, 19))
    got = four_russians.scores(four_russians.subset_sums(a, np.int64), four_russians.pack(x, 10))
    assert (got == x @ a.T).all()


# --- n-gram Jaccard join ----------------------------------------------------------


def shingle_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_classes(docs, percent=80):
    sets = [(i, shingle_set(t)) for i, t in docs]
    lists = defaultdict(list)
    for x, (_, s) in enumerate(sets):
        for g in s:
            lists[g].append(x)
    low = list(range(len(sets)))

    def root(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for x, (_, s) in enumerate(sets):
        met = Counter(y for g in s for y in lists[g] if y > x)
        for y, n in met.items():
            if 100 * n >= percent * (len(s) + len(sets[y][1]) - n):
                low[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    return Counter((i, len(s), least.get(root(x))) for x, (i, s) in enumerate(sets))


def near_copies(seed, n_words, groups, most):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 5))) for _ in range(n_words)]
    out = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(30, 200))
        for _ in range(rng.randint(1, most)):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own = own[: int(len(own) * rng.uniform(0.75, 1))]
            out.append("\n".join(own).replace("a", "A", 1))
    return out


@pytest.mark.parametrize("shard", [overlap_search.SHARD, 3000])
def test_jaccard_classes_against_all_pairs(spark, shard):
    texts = near_copies(3, 400, 40, 14)
    docs = [(None, "lone words of a document without an id"), (1, None), (2, ""), (3, "a b"), (4, "A  B\n"), (5, "a b c d e"), (6, "a b c d e f"), (7, " ")]
    docs += [(10 + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (30, texts[20])]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, hashes string").repartition(5)
    assert Counter(tuple(r) for r in overlap_search.overlap_classes(df, shard=shard).collect()) == brute_classes(docs)
    assert overlap_search.overlap_classes(df.limit(0)).collect() == []


def test_search_finds_every_link_of_a_dense_and_a_loose_group():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 130, 100)).astype(np.uint64) for _ in range(60)]  # many pairs close to the limit
    for percent in (35, 40, 80):
        low = list(range(60))
        for v, m in overlap_search.search(overlap_search.Index(sets), sets, list(range(60)), percent):
            low = [low[v] if x == low[m] else x for x in low]
        want = list(range(60))
        for i in range(60):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    want = [want[i] if x == want[j] else x for x in want]
        assert Counter(Counter(low).values()) == Counter(Counter(want).values())


# --- token alignment --------------------------------------------------------------

PATHS = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
ODD = list("ab \n\t  é😀▁ﬁ's<>|x,.1２　´ñ中文字") + ["\x1c", "\x85", "\xa0", "​", "<|endoftext|>", "</s>", "<0x41>"]


def brute_spans(docs):
    a_tok, b_tok = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_tok.encode_special_tokens = True
    piece, back, found, counts = {v: k for k, v in a_tok.get_vocab().items()}, byte_of_char(), [], Counter()
    for i, t in docs:
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_tok.encode(t) if t else []
        a_raw = [bytes(back[c] for c in piece[x]) for x in a]
        b_raw = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(x) else p.replace("▁", " ").encode() for x in b for p in [b_tok.id_to_piece(x)]]
        if not t or not b"".join(a_raw) == b"".join(b_raw) == (" " + t).encode():
            found.append((i, None))
            continue
        a_end, b_end = (np.cumsum([len(x) for x in raw]).tolist() for raw in (a_raw, b_raw))
        links = [(x, y) for x, e, s in zip(a, a_end, [0, *a_end], strict=False) for y, f, r in zip(b, b_end, [0, *b_end], strict=False) if r < e and s < f]
        groups, p, q = [], 0, 0
        for end in sorted(set(a_end) & set(b_end)):
            x, y = a_end.index(end) + 1, b_end.index(end) + 1
            groups.append(",".join(map(str, a[p:x])) + "|" + ",".join(map(str, b[q:y])))
            p, q = x, y
        found.append((i, (len(a), len(b), groups, links)))
        counts.update(set(links))
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = Counter()
    for i, f in found:
        if f is None:
            out[i, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            n_a, n_b, groups, links = f
            out[i, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("most", [token_spans.BROADCAST_PAIRS, 20])
def test_alignment_against_the_libraries(spark, most):
    rng = random.Random(1)
    docs = [(i, "".join(rng.choices(ODD, k=rng.randint(0, 40)))) for i in range(250)]
    docs += [(1000, None), (1001, ""), (1002, " "), (1003, "<s> <0x41> </s>"), (1004, "a  b   c"), (1005, "x" * 3000), (None, "no id"), (1004, "a  b   c")]
    docs += [(2000 + i, " ".join(rng.choices(["the", "house,", "größe", "naïve.", "日本", "x1"], k=40))) for i in range(30)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, groups string, keys int").repartition(3)
    assert Counter(tuple(r) for r in queries.span_digests(df, most=most).collect()) == brute_spans(docs)


def test_alignment_of_an_empty_table(spark):
    assert queries.span_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_coarse_cuts_are_refined_inside_characters():
    pair = token_spans.Pair(*PATHS)
    a, b = pair.encode([" \U0001f9ff", " ok"])
    assert a.same.all() and b.same.all()
    assert a.ends[-1] == b.ends[-1] == len(" \U0001f9ff ok".encode())
    assert all(np.diff(a.ends, prepend=0) == pair.size_a[a.ids]) and all(np.diff(b.ends, prepend=0) == pair.size_b[b.ids])


def test_probes_of_a_visitor_below_the_bound_are_merged():
    """1000 members in one group and a visitor just below the bound of each: its
    probes are one merge, not a binary search per member."""
    rng = np.random.default_rng(1)
    core = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    near = [np.unique(np.concatenate([core[:180], rng.integers(0, 1 << 63, 20).astype(np.uint64)])) for _ in range(1000)]
    far = np.unique(np.concatenate([core[:140], rng.integers(0, 1 << 63, 60).astype(np.uint64)]))
    index, calls = overlap_search.Index(near), []
    probe = index.probe
    index.probe = lambda members, long: calls.append(len(members)) or probe(members, long)
    found = list(overlap_search.search(index, [near[0], far], [0, -1], 80))
    assert sorted(m for _, m in found) == list(range(1, 1000)) and {v for v, _ in found} == {0}
    assert calls == [999] or calls == [999, 1000]
    long = np.argsort(index.stop - index.start, kind="stable")[-50:]
    few, many = np.arange(3), np.arange(1000)
    assert (probe(many, long)[:3] == probe(few, long)).all()
