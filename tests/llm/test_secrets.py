"""Secret scan against Python's regular expressions, and the battery on planted tokens."""

import base64
import hashlib
import random
import re

from tidemark.llm import secret_battery as S

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(t):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


TEXTS = [
    None, "", "nothing here", "password=token:abcdefghij", "PassWord = 'hunter2hunter2'", "é token:\x20\x20abcdefgh ü api-key=12345678",
    "apikey=short api_key: longenough1 SECRET==aaaaaaaa", "AKIA" + "A" * 12 + " AKIAB AKIAAKIA1234567890", "0" * 31 + " " + "a1" * 16,
    "token=" + "0123456789abcdef" * 3, "x" * 100_000 + " secret: abcdefgh1", "token=a " * 500 + "token=abcdefgh " * 300, "😀secret=abcdefghi😀",
]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, base string, n_assign int")


def test_base_spans(spark):
    got = {r.doc_id: r for r in S.scan(docs(spark, TEXTS + [TEXTS[4]])).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        want = plain_base(t or "")
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), i
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [want.count(k + ":") for k in ("assign", "access", "hex")]
        assert want in got[i].spans or got[i].n_random
    assert S.scan(docs(spark, [])).collect() == []


def test_battery_finds_random_tokens_and_leaves_text(spark):
    rng = random.Random(5)
    planted = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(40)]
    planted += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=40)) for _ in range(40)]
    clean = ["internationalization_of_the_framework", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "2024-01-01-2024-01-02-2024-01-03", "/usr/local/share/documentation/files",
             "abcdefghijklmnopqrstuvwxyz0123456789", "ABABABABABABABABABABABABAB", "the" * 20, "a1a1a1a1a1a1a1a1a1a1a1a1a1a1", "SomeVeryLongCamelCaseIdentifierName"] * 8
    got = S.scan(docs(spark, [f"key {t} end" for t in planted + clean])).collect()
    hits = {r.doc_id for r in got if r.n_random}
    assert len([i for i in hits if i < len(planted)]) >= 0.9 * len(planted)
    assert not [i for i in hits if i >= len(planted)]


def test_battery_finds_one_random_token_in_a_hundred(spark):
    rng = random.Random(9)
    small, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = {"base32": small.upper() + "234567", "base36": small + digits, "upper-hex": digits + "ABCDEF", "small": small, "capital": small.upper(), "letters": small + small.upper()}
    planted = [(kind, "".join(rng.choices(letters, k=48))) for kind, letters in alphabets.items() for _ in range(20)]
    words = "the record of every partner request is written once and read again when payload changes are settled by review before submission section part version".split()
    joins = ["_".join, "/".join, "-".join, "".join, lambda w: "".join(w).upper(), lambda w: "".join(map(str.title, w)), lambda w: "".join(x + str(rng.randint(1, 2030)) for x in w)]
    clean = [("text", rng.choice(joins)(rng.choices(words, k=rng.randint(7, 9)))) for _ in range(99 * len(planted))]
    rows = planted + clean
    got = S.scan(docs(spark, [f"see {t} there" for _, t in rows])).collect()
    hits = [rows[r.doc_id][0] for r in got if r.n_random]
    assert all(hits.count(kind) >= 15 for kind in alphabets), hits
    assert hits.count("text") <= 0.01 * len(hits)


def test_redact_masks_whole_spans_and_keeps_other_columns(spark):
    got = S.redact(docs(spark, ["a password=hunter2hunter2 b", None, "", "é token=abcdefgh secret=abcdefgh", "clean", "secret=" + "a1" * 20])).collect()
    assert [r.text for r in got] == ["a [SECRET] b", None, "", "é [SECRET] [SECRET]", "clean", "[SECRET]"]
    assert got[0].base == "x" and got[0].asDict().keys() == {"doc_id", "text", "base", "n_assign"}
