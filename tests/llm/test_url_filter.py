import random

from pyspark.sql import functions as F

from haulrate.llm import url_filter


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return host, rest[:end]


def plain_rule(host, path):
    fits = [
        (len(of + start), of + start, verdict)
        for verdict, of, start in url_filter.RULES
        if (host == of or host.endswith("." + of)) and path.startswith(start)
    ]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en",
    "http://example.com/en/", "http://a.example.com/en/1", "http://x.net/es/1", "http://x.net/es", "ftp://x.net/fr/",
    "http://example.com", "http://example.com?x=://a.net/es/", "http://É.com/ü", "http://a.com/\nb", "x://y://z.net/es/",
    "http://com/", "http://notexample.com/en/", "http://www.example.com/en/", "http://q.org/" + "p" * 5000,
]


def _pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")


def test_parts_and_rules_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    for pages in (_pages(spark, URLS * 2), table):
        pages = pages.withColumns({"host": F.lit("mine"), "_grams": F.lit("mine"), "rule": F.lit(1)})
        url_of = {row.page_id: row.url for row in pages.collect()}
        rows = url_filter.judge(pages).collect()
        assert len(rows) == len(url_of)
        for row in rows:
            host, path = plain_parts(url_of[row.page_id])
            rule, verdict = plain_rule(host, path)
            assert (row.host, row.path, row.rule) == (host, path, rule), url_of[row.page_id]
            assert row.verdict == (verdict or ("block" if row.p_block >= 0.5 else "allow"))


def test_method_learns_from_rules(spark):
    rng = random.Random(1)
    urls = []
    for _ in range(400):
        name = "".join(rng.choice("abcdefg") for _ in range(6))
        urls += [f"http://{name}.example.com/en/{rng.random()}", f"http://{name}.site.com/de/x"]
    new = ["http://zz.example.com.io/en/1", "http://zz.site.com.io/de/x"]
    rows = url_filter.judge(_pages(spark, urls + new)).collect()
    by_id = {row.page_id: row for row in rows}
    first, second = (by_id[len(urls) + k] for k in (0, 1))
    assert first.rule is None and first.verdict == "block"
    assert second.rule is None and second.verdict == "allow"


def test_nothing_or_one_verdict_to_learn_from(spark):
    only = url_filter.judge(_pages(spark, ["http://a.net/es/1", "http://b.org/"])).collect()
    assert {row.verdict for row in only} == {"block"}
    none = url_filter.judge(_pages(spark, ["http://b.org/", None])).collect()
    assert {row.verdict for row in none} == {"allow"}
    assert url_filter.judge(_pages(spark, [])).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    plan = url_filter.judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
