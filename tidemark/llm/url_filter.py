"""URL filter: longest host/path rule, else a list of canonical URLs.

Method: a blocked Bloom filter of the listed canonical URLs passes possible
hits to an exact hash join that removes the false positives. Every step is a
DataFrame expression.

- A URL hashes to one block of 256 bits (four longs) and to two bits in each
  long. The filter is a table of blocks, built with ``bit_or`` (partial
  aggregation), of at most ``MAX_BLOCKS`` rows: the only thing broadcast, and
  its size bound does not depend on the list. A list beyond that bound only
  raises the share of false positives that the exact join removes.
- Most pages are settled by the filter without a shuffle. Only possible hits
  are shuffled, on their canonical URL, against the distinct list; a hot URL
  is a skewed key of a plain equi join, which AQE splits.

Defined cases: a null URL, or one without ``://``, has empty host and path,
fits no rule and is never listed (verdict ``allow``); repeated rows each give
a row; an empty list allows everything that no rule blocks; columns of the
pages other than the id and the URL are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, written

BLOCK_BITS = 256
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 18  # 8 MB of bits: the proven bound of the broadcast
HASHES = 8  # two bits in each of the four longs


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling per page: no scheme, no fragment, host in lower case without
    a leading ``www.`` or ``m.``, no trailing ``/`` or ``/index.html``, query
    without ``utm_`` parameters. Null where there is no ``://``."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(/index\.html|/)+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, r"(^|&)utm_[^&]*", "")
    query = F.regexp_replace(query, r"^&+", "")
    query = F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, query))


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def longest_rule(rules: list[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits ``host`` and ``path``."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        out = F.when(_fits(rule), F.lit(value(rule))).otherwise(out)
    return out


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def _masks(key: Column) -> list[Column]:
    """Four longs with two bits each, from the six-bit pieces of a second hash."""
    h = F.xxhash64(F.lit("bits"), key)

    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(HASHES // 2)]


def bloom_blocks(listed: DataFrame, n_listed: int) -> tuple[DataFrame, int]:
    """The filter of column ``canon`` as (block, w0..w3), and its number of blocks."""
    blocks = max(1, min(MAX_BLOCKS, -(-n_listed * BITS_PER_URL // BLOCK_BITS)))
    masks = _masks(F.col("canon"))
    bits = listed.select(_block(F.col("canon"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(masks))]), blocks


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], *, id_col: str = "page_id",
               url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, listed) for every row of ``pages``.

    The verdict is that of the longest rule that fits; without one, ``block``
    if the canonical URL is listed, else ``allow``.
    """
    names = written(
        listed.select(canonical(F.col(listed_col)).alias("canon")).where("canon is not null").distinct(), "listed-urls"
    )
    bloom, blocks = bloom_blocks(names, names.count())
    url = F.col(url_col)
    told = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canon"))
    told = told.select(
        "*", longest_rule(rules, lambda r: r.text).alias("rule"), longest_rule(rules, lambda r: r.verdict).alias("said")
    )
    masks = _masks(F.col("canon"))
    has = F.lit(True)
    for i, m in enumerate(masks):
        has = has & (F.col(f"w{i}").bitwiseAND(m) == m)
    probed = told.withColumn("block", F.when(F.col("rule").isNull(), _block(F.col("canon"), blocks)))
    probed = written(
        probed.join(F.broadcast(bloom), "block", "left")
        .withColumn("possible", F.coalesce(F.col("canon").isNotNull() & has, F.lit(False)))
        .select("id", "host", "path", "rule", "said", "canon", "possible"),
        "probed-urls",
    )
    exact = (
        probed.where("possible")
        .join(names.withColumn("listed", F.lit(True)), "canon", "left")
        .select("id", "host", "path", "rule", "said", F.coalesce("listed", F.lit(False)).alias("listed"))
    )
    clear = probed.where("not possible").select("id", "host", "path", "rule", "said", F.lit(False).alias("listed"))
    verdict = F.coalesce("said", F.when(F.col("listed"), "block").otherwise("allow"))
    return clear.unionByName(exact).select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "listed")
