import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratalake.llm import url_filter

URLS = [
    "https://a.example.net/en/1?x=1", "http://EXAMPLE.net/en/", "http://example.net/de/2", "http://example.com/de/x#y", "http://sub.example.com/de/", "http://example.com/en/de/",
    "http://x.org/fr/1", "http://org/fr/", "http://x.org/en/1", "http://badexample.com/de/", "ftp://host.com", "http://host.com?q=/de/", "http://host.com#a/b", "nothing", "", None,
    "http://host.com/a/b/c?d://e", "a://B.C/D?E#F", "http://notnet/", "http://net", "http://x.net", "http://x.net/"]
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def expected(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def pages(spark, rows):
    return spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(rows)], "page_id bigint, url string, html string, verdict string")


def test_hosts_paths_and_rules(spark):
    got = url_filter.report(pages(spark, URLS))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    for r in got.collect():
        host, path, rule, verdict = expected(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_entropy(spark):
    row = spark.createDataFrame([("abca-0",), ("",)], "u string").select(url_filter.entropy(F.col("u")).alias("e")).collect()
    n = Counter("abca-0")
    assert row[0].e == pytest.approx(-sum(c / 6 * math.log2(c / 6) for c in n.values())) and row[1].e == 0


def test_trees_learn_lexical_signs_from_labelled_urls(spark):
    rows = []
    for k in range(300):
        rows += [f"http://a{k}.example.com/de/{k}?p={k}&q=1&r=2&s=3", f"https://b.example.org/fr/{k}"]
    rows += [f"http://c{k}.example.io/xx/{k}?p={k}&q=1&r=2&s=3" for k in range(40)] + [f"https://d.example.io/xx/{k}" for k in range(40)]
    got = {r.page_id: r.verdict for r in url_filter.report(pages(spark, rows)).collect()}
    asked = [got[k] for k in range(600, 680)]
    assert asked[:40].count("block") >= 36 and asked[40:].count("allow") >= 36


def test_a_hot_url_does_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TRAINING", 200)
    rows = []
    for k in range(150):
        rows += [f"http://a{k}.example.com/de/{k}?p={k}&q=1&r=2&s=3", f"https://b.example.org/fr/{k}"]
    found = pages(spark, rows).orderBy(F.xxhash64("url")).first().url
    asked = [f"http://c{k}.example.io/xx/{k}?p={k}&q=1&r=2&s=3" for k in range(20)] + [f"https://d.example.io/xx/{k}" for k in range(20)]
    got = {r.page_id: r.verdict for r in url_filter.report(pages(spark, [*asked, *rows, *[found] * 400])).collect()}
    verdicts = [got[k] for k in range(40)]
    assert verdicts[:20].count("block") >= 18 and verdicts[20:].count("allow") >= 18


def test_statistics_count_all_labelled_urls(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TRAINING", 4)
    rows = [f"http://d{k}.net/{j}" for k in range(30) for j in range(k + 1)] + ["http://e.org/fr/"] * 5 + ["http://e.org/en/"] * 7
    sums = url_filter.statistics(url_filter.labelled_urls(pages(spark, rows)))
    assert {r[0]: (r.s, r.n) for r in sums["_domain"].collect()} == {f"d{k}.net": (k + 1, k + 1) for k in range(30)} | {"e.org": (0, 5)}
    assert {r[0]: (r.s, r.n) for r in sums["_suffix"].collect()} == {"net": (465, 465), "org": (0, 5)}


def test_no_labels_and_no_rows(spark):
    assert {r.verdict for r in url_filter.report(pages(spark, ["http://x.io/", None])).collect()} == {"allow"}
    assert url_filter.report(pages(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = url_filter.report(pages(spark, URLS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
