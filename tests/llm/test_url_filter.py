from __future__ import annotations

import time

import oracle
from ledgerloom.llm import url_filter as uf
from ledgerloom.llm.common import ORACLES, QUERIES

URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG", "http://example.org/", "https://a.example.org/es/x?y=/en/1",
    "x://example.org/en/1", "x://example.org/en/2", "http://notexample.org/es/", "http://b.com/de/1#top", "http://com/fr/",
    "http://xcom/fr/", "http://a.net/p", "http://a.net/p/", "http://A.net/p#x", "http://a.net/q", "http://é.com/de/É",
    "http://u.org://v.com/fr/", "http://q.com?x=/fr/",
]


def plain(url: str | None):
    after = (url or "").partition("://")[2]
    host = after
    for c in "/?#":
        host = host.partition(c)[0]
    path = after[len(host):].partition("?")[0].partition("#")[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in uf.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else None


def frames(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id bigint, url string, host string")
    return pages, spark.createDataFrame(uf.RULES, "host string, path string, verdict string")


def test_query_equals_sql(spark, small_folder):
    problems, _ = oracle.compare(
        spark, oracle.connect(small_folder), QUERIES["op2_url_filter"], ORACLES["op2_url_filter"], small_folder)
    assert not problems


def test_hosts_paths_rules_and_lists(spark):
    pages, rules = frames(spark)
    for limit in (uf.BROADCAST_BYTES, 0):  # both ways to join
        held, uf.BROADCAST_BYTES = uf.BROADCAST_BYTES, limit
        try:
            got = {r.page_id: r for r in uf.judge(pages, rules, uf.recrawled(pages)).collect()}
        finally:
            uf.BROADCAST_BYTES = held
        assert len(got) == len(URLS)
        for i, url in enumerate(URLS):
            host, path, rule, verdict = plain(url)
            assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
            listed = i in (4, 5, 13, 14, 15)
            assert got[i].listed == listed, url
            assert got[i].verdict == (verdict or ("block" if listed else "allow")), url


def test_repeated_rows_stay_and_empty_tables_pass(spark):
    pages, rules = frames(spark)
    twice = pages.unionByName(pages)
    assert uf.judge(twice, rules, uf.recrawled(pages)).count() == 2 * len(URLS)
    assert uf.judge(pages.limit(0), rules, uf.recrawled(pages.limit(0))).count() == 0
    none = uf.judge(pages, rules.limit(0), uf.recrawled(pages.limit(0))).collect()
    assert {r.verdict for r in none} == {"allow"} and len(none) == len(URLS)


def test_filter_lets_all_listed_pass_and_few_others(spark):
    listed = spark.range(20_000).selectExpr("concat('http://h', id) AS key")
    others = spark.range(20_000, 60_000).selectExpr("concat('http://h', id) AS key")
    blocks = uf.blocks_for(20_000)
    words = uf.bloom(listed, blocks)
    assert uf.possible(listed, words, blocks).count() == 20_000
    assert uf.possible(others, words, blocks).count() < 400


def test_plan_has_no_python_and_no_product(spark, small_folder, capsys):
    QUERIES["op2_url_filter"](spark, small_folder).explain()
    plan = capsys.readouterr().out
    assert not [x for x in ("Python", "Arrow", "Cartesian", "NestedLoop") if x in plan]


def test_hosts_of_many_labels_take_seconds(spark):
    urls = ["http://" + "a." * 300_000 + "example.org/en/1", "http://" + "." * 500_000, "http://org" + "/x" * 300_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = spark.createDataFrame(uf.RULES, "host string, path string, verdict string")
    began = time.perf_counter()
    got = {r.page_id: (r.rule, r.verdict) for r in uf.judge(pages, rules, uf.recrawled(pages)).collect()}
    assert time.perf_counter() - began < 60
    assert got == {i: plain(u)[2:] if plain(u)[2] else (None, "allow") for i, u in enumerate(urls)}


def test_other_columns_are_left_alone(spark):
    pages = spark.createDataFrame([(1, "http://org/", "h", "p", "r")], "page_id bigint, url string, host string, key string, rule string")
    rules = spark.createDataFrame(uf.RULES, "host string, path string, verdict string")
    row = uf.judge(pages, rules, uf.recrawled(pages)).first()
    assert (row.host, row.path, row.rule, row.verdict) == ("org", "/", "org/", "allow")
