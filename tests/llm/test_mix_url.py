"""Source mixing and URL filter on small fixtures, against plain Python."""

import math
from hashlib import md5

import pytest

from tidemark.llm import mix_sources, url_filter

DOCS = "doc_id bigint, text string, source string, size int, target string, id string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x", "y") for i, t, s in rows], DOCS)


def plain_targets(sizes: dict) -> dict:
    """Reshare the excess by weight until no target is above twice its source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(out.values())
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w >= 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / w for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            free.discard(s)
    return out


def test_targets_and_taken(spark):
    rows = [(i, "w " * (1 + i * 7 % 23) + "#" * (i % 4), ["a", "b", None, "é", "c"][i % 5 if i % 2 else 0]) for i in range(400)]
    got = mix_sources.mix(docs(spark, rows)).collect()
    assert len(got) == 400
    size = {i: len(t.split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    sizes: dict = {}
    for i, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[i]
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], sizes[s])
        assert math.isclose(r.target, want[s])
        assert r.taken in {r["size"] * c for c in (0, 1, 2)}
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 23, s
    # the epoch's fraction is a prefix in the order of the keys
    def key(i):
        u = (int(md5(str(i).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        text = next(t for j, t, _ in rows if j == i)
        return -math.log(u) / ((len(text) - text.count("#")) / len(text)) ** 2

    for s in sizes:
        own = sorted((r for r in got if source[r.doc_id] == s), key=lambda r: key(r.doc_id))
        copies = [r.copies for r in own if r["size"]]
        assert copies == sorted(copies, reverse=True)
    again = {(r.doc_id, r.taken) for r in mix_sources.mix(docs(spark, rows)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_mix_with_many_ranges_equals_one_range(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 9) + "&" * (i % 5), "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    one = {(r.doc_id, r.taken) for r in mix_sources.mix(docs(spark, rows)).collect()}
    monkeypatch.setattr(mix_sources, "ROWS_PER_RANGE", 8)
    assert {(r.doc_id, r.taken) for r in mix_sources.mix(docs(spark, rows)).collect()} == one


def test_mix_edges(spark):
    assert mix_sources.mix(docs(spark, [])).collect() == []
    got = mix_sources.mix(docs(spark, [(1, None, None), (1, None, None), (None, "a b", None), (3, "", "x"), (4, "###", "y")])).collect()
    assert sorted((r.doc_id is None, r["size"]) for r in got) == [(False, 0), (False, 0), (False, 0), (False, 1), (True, 2)]
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)


URLS = [
    None, "", "no-scheme/x", "http://", "HTTP://WWW.Example.com/en/1?x=1", "https://example.com/en/", "https://a.example.com/en",
    "https://badexample.com/en/1", "http://x.net/fr/a#b", "http://x.net/es", "http://x.net/es/", "https://spam.org/A/?utm_source=x",
    "http://www.spam.org/A/index.html#top", "http://spam.org/A?b=1&utm_x=2", "http://spam.org/a", "x://Ünï.org/Ä", "x://a://b/c", "http://h?x", "http://h#x",
]


def test_url_parts_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "z", 1) for i, u in enumerate(URLS)] + [(11, URLS[11], "z", 1)], "page_id long, url string, host string, block long")
    listed = spark.createDataFrame([("http://m.spam.org/A/",), (None,), ("nothing",)], "url string")
    rules = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
             url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"), url_filter.Rule("block", "net", "/fr/")]
    got = sorted(url_filter.judge_urls(pages, listed, rules).collect(), key=lambda r: r.page_id)
    assert len(got) == len(URLS) + 1
    by = {r.page_id: r for r in got}
    assert [(by[i].host, by[i].path) for i in (0, 2, 3)] == [("", "")] * 3
    assert (by[4].host, by[4].path, by[4].rule, by[4].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert by[5].verdict == "block" and by[6].rule == "com/" and by[7].rule == "com/"
    assert by[8].rule == "net/fr/" and by[9].rule is None and by[10].rule == "net/es/"
    assert [by[i].verdict for i in (11, 12, 13, 14)] == ["block", "block", "allow", "allow"]
    assert (by[15].host, by[15].path) == ("Ünï.org", "/Ä")
    assert (by[16].host, by[16].path) == ("a:", "//b/c")
    assert (by[17].host, by[18].host) == ("h", "h")


@pytest.mark.parametrize("cap", [1, 1 << 18])
def test_crowded_filter_only_adds_work(spark, monkeypatch, cap):
    """With one block nearly every page is a possible hit; the exact join still decides."""
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", cap)
    pages = spark.range(500).selectExpr("id page_id", "concat('http://h.org/', id) url")
    listed = pages.where("page_id % 7 = 0").select("url")
    got = url_filter.judge_urls(pages, listed, []).where("verdict = 'block'").collect()
    assert sorted(r.page_id for r in got) == list(range(0, 500, 7))


def test_url_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge_urls(pages, pages.limit(0), []).collect()] == ["allow"]
    assert url_filter.judge_urls(pages.limit(0), pages, []).collect() == []


@pytest.mark.parametrize("ranges", [4096, 8])
def test_rows_of_one_place_are_taken_one_by_one(spark, monkeypatch, ranges):
    """Repeated rows and null ids: as near the target as rows with ids of their own."""
    monkeypatch.setattr(mix_sources, "ROWS_PER_RANGE", ranges)
    text = "one two three"
    tables = {
        "equal rows": [(1, text, "a")] * 1000,
        "null ids": [(None, text, "a")] * 1000,
        "own ids": [(i, text, "a") for i in range(1000)],
        "null ids, own texts": [(None, f"{text} x{i}", "a") for i in range(1000)],
        "a third equal": [(7, text, "a")] * 300 + [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(600)],
        "null source and text": [(7, text, None)] * 300 + [(None, None, None)] * 50 + [(i, text, "b") for i in range(50)],
    }
    for name, rows in tables.items():
        if ranges == 8 and name not in ("equal rows", "a third equal"):
            continue
        table = docs(spark, rows).repartition(5)
        got = mix_sources.mix(table).collect()
        assert len(got) == len(rows), name
        want = {round(r.target, 3): r.source_size for r in got}
        for target, total in want.items():
            own = [r for r in got if round(r.target, 3) == target and r.source_size == total]
            assert abs(sum(r.taken for r in own) - target) <= max(r["size"] for r in own), (name, target)
            assert all(r.taken <= 2 * r["size"] for r in own)
        if name == "a third equal":
            again = sorted((r.doc_id, r["size"], r.taken) for r in mix_sources.mix(table).collect())
            assert again == sorted((r.doc_id, r["size"], r.taken) for r in got)
        copies = mix_sources.mixed(table)
        assert copies.columns == table.columns
        words = sum(len((r.text or "").split()) for r in copies.collect())
        assert words == sum(r.taken for r in got), name
