import random

from pyspark.sql import functions as F

from phenoloom.llm import url_templates as U
from phenoloom.llm.queries import URL_RULES

URLS = [
    None, "", "no host", "http://", "HTTP://EXAMPLE.com/de/1", "http://example.com/de", "http://example.com/de/", "http://xexample.com/de/1",
    "https://a.b.example.NET/en/7?x=://y", "https://www.example.net/fr/7", "ftp://net/", "ftp://net", "a://b.net?q/", "a://b.org/fr/#top", "a://B.ORG/fr/x\ny",
    "x://ÄÖ.org/FR/1", "p://c.net:80/en/", "q://host.example.net#/en/", "r://u@example.net/en/1?", "s://http://net/", "http://org/fr/", "http://orga/fr/",
]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule(host, path):
    fits = [r for r in URL_RULES if (host == (h := r.partition("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h) :])]
    return max(fits, key=len, default=None)


def test_hosts_paths_and_rules(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    pages = pages.unionByName(spark.createDataFrame([(-1 - i, u) for i, u in enumerate(URLS)], "page_id long, url string"))
    urls = {r.page_id: r.url for r in pages.collect()}
    rows = U.judge(pages, URL_RULES).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == split(urls[r.page_id])
        assert r.rule == rule(r.host, r.path)
        if r.rule:
            assert r.verdict == URL_RULES[r.rule]


def site(paths_with_labels):
    return [("h", path, bad) for path, bad in paths_with_labels]


def judged(spark, rows):
    df = spark.createDataFrame(rows, "host string, path string, bad int").withColumn("shapes", U.path_shapes(F.col("path")))
    tree = {tuple(r.shapes): r for r in U.templates(df.select("host", "shapes", "bad")).collect()}
    return {r.path: tree[tuple(r.shapes)] for r in df.collect()}


def test_impure_templates_are_rejected_and_their_siblings_not(spark):
    rows = [("h", f"/buy/{i}", 1) for i in range(40)] + [("h", f"/news/{i}", 0) for i in range(40)] + [("h", f"/buy/{i}", None) for i in range(100, 120)] + [("h", f"/other/{i}", None) for i in range(9)]
    got = judged(spark, rows)
    assert got["/buy/110"].reject and not got["/news/3"].reject and not got["/other/3"].reject
    assert abs(got["/buy/110"].purity - (40 + U.PRIOR_WEIGHT * U.PRIOR_BAD) / (40 + U.PRIOR_WEIGHT)) < 1e-9


def test_variable_segments_become_wildcards(spark):
    draw = random.Random(3)
    names = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(60)]
    got = judged(spark, [("h", f"/u/{n}/profile", 1) for n in names] + [("h", "/u/zzzzzq/profile", None), ("h", "/v/zzzzzq", None)])
    assert {r.template for path, r in got.items() if path.startswith("/u")} == {"/u/*/profile"}
    assert got["/u/zzzzzq/profile"].reject and not got["/v/zzzzzq"].reject


def test_like_siblings_merge(spark):
    rows = [("h", f"/{a}/{i}.html", None) for a in ("en", "fr", "es") for i in range(30)] + [("h", f"/blog/x{i}/y{i}/z", None) for i in range(3)]
    got = judged(spark, rows)
    assert got["/en/1.html"].template == got["/fr/2.html"].template == got["/es/3.html"].template


def test_shapes_and_empty(spark):
    one = lambda p: spark.range(1).select(U.path_shapes(F.lit(p)).alias("s")).first().s
    assert one("/a1/22/deadbeef99//x.html") == ["a{n}", "{n}", "{hex}", "x.html"] and one("") == []
    assert one("/1/2/3/4/5/a/b/c") == ["{n}"] * 5 + ["a/b/c"]
    none = spark.createDataFrame([], "page_id long, url string, host string")
    assert U.judge(none, URL_RULES).count() == 0
    more = U.judge(spark.createDataFrame([(1, "a://q.fr/x/1"), (1, "a://q.fr/x/1")], "page_id long, url string"), URL_RULES, labels=spark.createDataFrame([(1, 1)], "page_id long, bad int"))
    assert [r.verdict for r in more.collect()] == ["allow", "allow"]
