from phenoloom.llm import url_templates as U
from phenoloom.llm.queries import URL_RULES


def judged(spark, urls):
    rows = U.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), URL_RULES).collect()
    return {urls[r.page_id]: r for r in rows}


def test_purity_of_ruled_pages_reaches_alike_branches_without_labels(spark):
    ruled = [f"http://m.casino.example.com/de/{i}.html" for i in range(12)]
    alike = [f"http://m.casino.example.com/{a}/{i}.html" for a in ("en", "fr") for i in range(12)]
    unlike = [f"http://m.casino.example.com/about/us{'x' * i}/team/y" for i in range(6)]
    got = judged(spark, [*ruled, *alike, *unlike])
    assert all(got[u].rule is None and got[u].verdict == "block" for u in alike)
    assert all(got[u].verdict == "allow" for u in unlike)


def test_a_branch_like_bad_and_good_ones_joins_neither(spark):
    bad = [f"http://a.example.net/xx/{i}.html" for i in range(12)]
    good = [f"http://a.example.net/en/{i}.html" for i in range(12)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*bad, *good, "http://a.example.net/fr/1.html"])], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "page_id long, bad int")
    rules = {"example.net/en/": "allow"}
    rows = {r.page_id: r for r in U.judge(pages, rules, labels=labels).collect()}
    assert rows[0].verdict == "block" and rows[12].verdict == "allow" and rows[24].verdict == "allow"
