"""Secret scan: three base patterns, and a randomness test battery for the rest.

Base spans are regular expressions. Further candidates are unbroken tokens of
20 or more characters that overlap no base span. Each is given the smallest
encoding that holds all its characters (``ENCODINGS``, from decimal to base 64
with either pair of marks) and tested over that alphabet. Two tests ask whether
it is uniform: chi-squared of the characters (Wilson-Hilferty normal score) and
serial correlation of neighbouring values. A token that fails either is no
secret (p = 1). Three more ask how unlike text it is, each as a ratio of
likelihoods, uniform over the encoding to text:

- runs of character classes (small, capital, digit, mark): words, numbers and
  identifiers change class at no more than ``CHANGE_RATE`` of their places
  (``SINGLE_RATE`` where letters have one case), the encoding at its own rate;
- frequencies of the characters, as the likelihood form of chi-squared: letters
  of text (also against the few letters of hexadecimal) and digits;
- neighbouring letters, whatever their case: the pairs of text.

The product of the ratios, over the number of encodings to choose from, has mean
at most 1 if the token is text, so its reciprocal is a p-value at every length
(Markov). ``PAIRS`` holds the second and third as one table, a mixture of 3/4
text and 1/4 uniform, so no pair counts more than 4 times for a secret. It was
counted in message catalogues in English, German, French, Spanish, Italian,
Portuguese and Dutch and in the names of Python's library, without accents.

P-values go through Benjamini-Hochberg control, separately for each length band
(powers of two):
short tokens are many and weak and meet a stricter cut than long ones. P-values
are rounded up to a grid of ``exp(-1/8)`` steps, so the control needs only
counts per band and step (at most 32 x 513 rows), not a global sort.

Every step is a DataFrame expression. Texts are read once; a narrow table of
spans and candidates is written, the counts are a partial aggregate over it,
and the cuts (at most one per band) come back as a literal. No document is
shuffled.

Defined cases: a null or empty text has no spans; repeated rows each give a
row (and each count in the control); without candidates nothing is added;
positions are code points, ends exclusive; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import written

# kind -> (pattern, group whose length counts, least length)
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 1, 8), "access": (r"AKIA[A-Z0-9]{12,}", 0, 16), "hex": (r"[0-9a-f]{32,}", 0, 32)}
RANDOM = "random"
KINDS = [*BASE, RANDOM]
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"

SMALL = "abcdefghijklmnopqrstuvwxyz"
LARGE = SMALL.upper()
DIGITS = "0123456789"
# the first that fits is the inferred encoding
ENCODINGS = [
    ("^[0-9]+$", DIGITS), ("^[0-9a-f]+$", DIGITS + "abcdef"), ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[a-z]+$", SMALL), ("^[A-Z]+$", LARGE), ("^[A-Z2-7]+$", LARGE + "234567"), ("^[a-z2-7]+$", SMALL + "234567"),
    ("^[a-z0-9]+$", DIGITS + SMALL), ("^[A-Z0-9]+$", DIGITS + LARGE), ("^[A-Za-z]+$", LARGE + SMALL), ("^[A-Za-z0-9]+$", LARGE + SMALL + DIGITS),
    ("^[A-Za-z0-9+/]+$", LARGE + SMALL + DIGITS + "+/"), ("^[A-Za-z0-9_-]+$", LARGE + SMALL + DIGITS + "-_"),
    ("", LARGE + SMALL + DIGITS + "+/-_"),
]
CHANGE_RATE = 0.25
SINGLE_RATE = 0.1
# a row for the letter that starts a run of letters, then one per letter before; a
# base-36 digit per letter: 24 + 8 ln(uniform / text), rounded down
PAIRS = """
irmngsrrixumpkkoxklknsvwww
spllyvpvpwsgmfrqxfkhqrwwtv
euuxcxxxgqyfvxixzjruiyxypy
eyqxiyycjynpxybxyowipyyzxy
gxys6xxxexyuxxfxzsrvnxxywy
pulmqrrwpxvkodwrwdflutwpww
ixxuilwy8yyoxxdxymrpkyyyuy
ivxw8yqqhyxpvkmvzknsgyxyxy
cyyx8yyxfyypvuhyypvlnyxzxy
nrjnlqoyyuvknciswnijwqyvys
cwxmauvxkymvynftzxqyhsxzys
dvwwaxtqiysrwqhuypmlmxszwx
ewwpbwvvdyxiwxhvyxqnnwyxqy
blyxayyyhyyvnwhhzxsvoyyyxy
hxmhhsgvkxtvxrhwyxlepsyywv
vronsrsxtyumjbrmydkmlrrxyy
cwtvexwunzxjxxenyfsllyyyux
syyyxyyyuyzxyyxyxwxw0ytzyy
fvroawqxgyuvpqhwyomlpvvysx
kxlxdwwogyutwwlmxxicmxwysy
fyuwbwyjeyyuxxgvzioooxwyrw
mpqrisrxlxukjfvnygihxwwwxw
ayyy6yyyfzzxxxfxztwyvxyyyy
byxvcyxjcyytyngyzmrysywxxy
luiwguywdzxwtyreyxvawyxsrv
ftuwlwvymywrkmieyrggowtywx
bxxy9yxtbxyvvxlyxxxsjytzwn
""".split()
REJECT_Z = 3.3  # two-sided level of about 0.001 for either uniformity test
FDR = 0.01
STEPS = 512  # of the p-value grid, each a factor exp(-1/8)
MASK = "[SECRET]"


def _long(x) -> Column:
    return F.lit(x).cast("long")


def matches(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Array of (start, end) of the matches whose ``group`` has ``least`` or more
    characters. Starts follow from the lengths of the gaps and the matches."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    counted = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("len"), counted.alias("n"))
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["len"], F.lit(0))
        more = F.concat(acc["out"], F.array(F.struct(start.alias("s"), end.alias("e"))))
        return F.struct(end.alias("at"), F.when(x["n"] >= least, more).otherwise(acc["out"]).alias("out"))

    spans = F.aggregate(parts, F.struct(_long(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """Array of (s, k, e), k the place of the kind in KINDS."""
    return F.array_sort(F.concat(*[_as(matches(text, *BASE[kind]), kind) for kind in BASE]))


def _as(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e")))


def _encoding(letters: str) -> Column:
    """The alphabet and its logs of uniform over text: at a class change, at none, per letter and per digit."""
    cases = [sum(c in own for c in letters) for own in (SMALL, LARGE)]
    digits = sum(c in DIGITS for c in letters)
    shares = [n / len(letters) for n in (*cases, digits, len(letters) - sum(cases) - digits)]
    change, rate = 1 - sum(x * x for x in shares), CHANGE_RATE if all(cases) else SINGLE_RATE
    logs = {
        "change": math.log(change / rate) if change > rate else 0.0, "stay": math.log((1 - change) / (1 - rate)) if change > rate else 0.0,
        "letter": math.log(26 / max(cases)) if any(cases) else 0.0, "digit": math.log(10 / digits) if digits else 0.0,
    }
    return F.struct(F.lit(letters).alias("alphabet"), *[F.lit(x).alias(name) for name, x in logs.items()])


def _inferred(token: Column) -> Column:
    out = _encoding(ENCODINGS[-1][1])
    for pattern, letters in reversed(ENCODINGS[:-1]):
        out = F.when(token.rlike(pattern), _encoding(letters)).otherwise(out)
    return out


def _values(x: Column) -> Column:
    letters = F.split(x["token"], "")
    return F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["code"].alias("code"), F.length(x["code"]["alphabet"]).cast("double").alias("k"),
        F.transform(letters, lambda c: (F.instr(x["code"]["alphabet"], c) - 1).cast("double")).alias("v"),
        F.transform(letters, lambda c: F.instr(F.lit(SMALL), F.lower(c))).alias("l"),
        F.transform(letters, lambda c: F.when(c.between("a", "z"), 0).when(c.between("A", "Z"), 1).when(c.between("0", "9"), 2).otherwise(3)).alias("c"),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _means(x: Column) -> Column:
    # a step of its own: inside a lambda it would be taken again for every character
    return x.withField("mean", _sum(x["v"]) / F.size(x["v"]))


def _moments(x: Column) -> Column:
    n = F.size(x["v"]).cast("double")
    counts = F.transform(F.array_distinct(x["v"]), lambda a: F.size(F.filter(x["v"], lambda b: b == a)).cast("double"))
    off = F.transform(x["v"], lambda a: a - x["mean"])
    changes = F.zip_with(F.slice(x["c"], 2, F.size(x["c"])), x["c"], lambda a, b: F.when(a != b, 1.0).otherwise(0.0))
    # zip_with pads the shorter side with null: the last pair counts as no change
    logs = F.lit([(int(c, 36) - 24) / 8 for row in PAIRS for c in row])
    earlier = F.concat(F.array(F.lit(0)), F.slice(x["l"], F.lit(1), F.size(x["l"]) - 1))
    pairs = F.zip_with(earlier, x["l"], lambda a, b: F.when(b > 0, F.element_at(logs, 26 * a + b)).otherwise(0.0))
    return F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["code"].alias("code"), x["k"].alias("k"), n.alias("n"), off.alias("off"),
        _sum(F.transform(counts, lambda a: a * a)).alias("squares"), _sum(changes).alias("changes"),
        _sum(pairs).alias("pairs"), F.size(F.filter(x["l"], lambda a: a > 0)).alias("letters"), F.size(F.filter(x["c"], lambda a: a == 2)).alias("digits"),
    )


def _tests(x: Column) -> Column:
    df = x["k"] - 1
    chi = F.greatest(x["k"] * x["squares"] / x["n"] - x["n"], F.lit(0.0))
    spread = 2 / (9 * df)
    uniform = (F.pow(chi / df, F.lit(1.0 / 3)) - (1 - spread)) / F.sqrt(spread)
    power = _sum(F.transform(x["off"], lambda a: a * a))
    lag = _sum(F.zip_with(F.slice(x["off"], 2, F.size(x["off"])), x["off"], lambda a, b: F.coalesce(a, F.lit(0.0)) * b))
    serial = F.when(power > 0, (lag / F.when(power > 0, power) + 1 / x["n"]) * F.sqrt(x["n"])).otherwise(F.lit(99.0))
    runs = x["changes"] * x["code"]["change"] + (x["n"] - 1 - x["changes"]) * x["code"]["stay"]
    letters = x["pairs"] + x["letters"] * x["code"]["letter"] + x["digits"] * x["code"]["digit"]
    depth = F.greatest(runs + letters - math.log(len(ENCODINGS)), F.lit(0.0))
    passes = (F.abs(uniform) <= REJECT_Z) & (F.abs(serial) <= REJECT_Z)
    step = F.when(passes, F.least(F.floor(8 * depth), F.lit(STEPS))).otherwise(F.lit(0))
    return F.struct(x["s"].alias("s"), x["e"].alias("e"), F.floor(F.log2(x["n"])).cast("int").alias("band"), step.cast("int").alias("step"))


def candidates(text: Column, base: Column) -> Column:
    """Array of (s, e, band, step): the other tokens with length band and p-value step."""
    found = F.filter(matches(text, TOKEN), lambda x: ~F.exists(base, lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"])))
    tokens = F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.substring(text, x["s"].cast("int") + 1, (x["e"] - x["s"]).cast("int")).alias("token")))
    tokens = F.transform(tokens, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["token"].alias("token"), _inferred(x["token"]).alias("code")))
    for step in (_values, _means, _moments, _tests):
        tokens = F.transform(tokens, step)
    return tokens


def scanned(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, base, more): base spans and tested candidates of every whole text."""
    told = docs.select(F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"))
    told = told.select("id", "text", F.coalesce(base_spans(F.col("text")), F.array()).alias("base"))
    return told.select("id", "base", F.coalesce(candidates(F.col("text"), F.col("base")), F.array()).alias("more"))


def cuts(found: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Length band -> the least step that Benjamini-Hochberg discovers."""
    counts = found.select(F.explode("more").alias("x")).groupBy("x.band", "x.step").agg(F.count(F.lit(1)).alias("n"))
    beyond = F.sum("n").over(W.partitionBy("band").orderBy(F.desc("step")))
    ranked = counts.select("band", "step", beyond.alias("r"), F.sum("n").over(W.partitionBy("band")).alias("m"))
    kept = ranked.where((F.col("step") > 0) & (F.exp(-F.col("step") / 8.0) <= fdr * F.col("r") / F.col("m")))
    return {r.band: r.least for r in kept.groupBy("band").agg(F.min("step").alias("least")).collect()}  # a row per band


def discovered(more: Column, cut: dict[int, int]) -> Column:
    """The candidates at or beyond their band's cut, as (s, k, e)."""
    def passes(x: Column) -> Column:
        out = F.lit(False)
        for band, step in sorted(cut.items()):
            out = out | ((x["band"] == band) & (x["step"] >= step))
        return out

    return _as(F.filter(more, passes), RANDOM)


def told(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, *, fdr: float = FDR, id_col: str = "doc_id") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every document."""
    found = written(scanned(docs, id_col), "secret-spans")
    both = found.select("id", "base", discovered(F.col("more"), cuts(found, fdr)).alias("added"))

    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return both.select(
        F.col("id").alias(id_col), *[n(k) for k in BASE], F.sha2(told(F.col("base")), 256).alias("base_sha256"),
        told(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_random"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span (sorted, maybe overlapping) replaced by MASK."""
    start = F.struct(_long(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (x["s"] - acc["at"]).cast("int"))
        out = F.when(x["s"] >= acc["at"], F.concat(acc["out"], gap, F.lit(MASK))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def redact(docs: DataFrame, *, fdr: float = FDR, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with all found spans of ``text`` masked; other columns unchanged.
    The cuts need the whole corpus, so texts are scanned twice, not shuffled."""
    cut = cuts(written(scanned(docs, id_col).select("more"), "secret-candidates"), fdr)
    text = F.col("text")
    # the row goes as one struct: no name of its columns can clash with one made here
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(row, "text", base_spans(text).alias("base"))
    added = discovered(candidates(text, F.col("base")), cut)
    spans = base.select("row", "text", F.array_sort(F.concat("base", added)).alias("spans"))
    masked = F.when(text.isNotNull(), redacted(text, F.col("spans")))
    return spans.select(*[(masked if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
