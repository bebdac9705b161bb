"""URL filter: parts, rules, features and trees, against plain versions and the SQL."""
import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import urls

SF = "/root/testdata/sf0.001"
ODD = [None, "", "no scheme/en/", "http://", "https://A.Example.NET/en/x", "http://example.net/en", "http://net", "http://net/", "http://x.net?y/",
       "http://notnet.com/de/", "http://www.EXAMPLE.com/de/", "http://org/fr/", "http://a.org/frx", "x://y://z.net/", "http://a..net/", "http://net./",
       "http://é.ORG/fr/ü?a=1&&b=2#c?d", "http://h#f/de/", "://example.com/de/1", "http://example.com/de/?q=/&r", "http://a.net/\n/b", "http://u:p@x.com:80/a//b/"]


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def plain_parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return lower(host), path, rest


def plain_rule(host, path):
    fits = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def table(spark, texts):
    extra = {c: F.lit("?") for c in ("host", "path", "rule", "verdict", "margin", "length", "depth", "domain", "_low", "y", "n", "p")}
    return spark.createDataFrame(list(enumerate(texts)), "page_id long, url string").withColumns(extra)


def sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    if rows:
        con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    return sorted(con.execute(urls.oracle()).fetchall(), key=repr)


def result(df):
    return sorted(map(tuple, df.select("page_id", "host", "path", "rule", "verdict", "margin").collect()), key=repr)


def test_odd_urls_parts_and_rules(spark):
    got = {r["page_id"]: r for r in urls.judge(table(spark, ODD)).collect()}
    assert len(got) == len(ODD)
    for i, u in enumerate(ODD):
        host, path, _ = plain_parts(u)
        rule = plain_rule(host, path)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (rule and rule[0] + rule[1])
        if rule:
            assert got[i]["verdict"] == rule[2]
    assert result(urls.judge(table(spark, ODD))) == sql(list(enumerate(ODD)))


def test_features_of_urls(spark):
    def bits(n):
        return math.floor(1000 * n * math.log(max(n, 1)) / math.log(2) + 0.5)

    long = "http://a.b-1.net/" + "x1/" * 200_000 + "?" + "p=1&" * 50_000
    texts = [*ODD, long, "1" * 1000]
    got = {r["page_id"]: r for r in urls.lexical(spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")).collect()}
    for i, u in enumerate(texts):
        u = u or ""
        host, path, rest = plain_parts(u)
        query = re.match(r"[^?#]*\?([^#]*)", rest)
        n, chars = max(len(u), 1), Counter(c if c in urls._CHARS else "" for c in lower(u))
        want = {"length": len(u), "depth": len([x for x in path.split("/") if x]), "digits": 1000 * len(re.findall("[0-9]", u)) // n,
                "entropy": (bits(n) - sum(map(bits, chars.values()))) // (10 * n), "params": len([x for x in (query[1] if query else "").split("&") if x]),
                "labels": host.count(".") + 1 if host else 0, "host_length": len(host), "host_marks": len(re.findall("[0-9-]", host))}
        assert {k: got[i][k] for k in want} == want


def made(rng, n):
    rows = []
    for _ in range(n):
        bad = rng.random() < 0.4
        host = rng.choice(["a", "bb", "news", "shop"]) + (f"-{rng.randint(10, 99999)}" if bad else "") + rng.choice([".com", ".net", ".co.uk"])
        path = "/".join(rng.choice(["x", "page", "about"]) for _ in range(rng.randint(1, 3)))
        tail = "?" + "&".join(f"k{j}={rng.randint(0, 9**9)}" for j in range(rng.randint(1, 4))) if bad else ""
        rows.append((f"http://{host}/{path}{tail}", bad))
    return rows


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(5)
    train, held = made(rng, 400), made(rng, 300)
    labelled = spark.createDataFrame(train + [("http://n.com/", None)], "url string, blocked boolean")
    got = {r["url"]: r["verdict"] for r in urls.judge(table(spark, [u for u, _ in held]), rules=(), labelled=labelled).collect()}
    assert sum((got[u] == "block") == bad for u, bad in held) > 0.97 * len(held)


def test_bound_of_labelled_urls(spark):
    df = spark.range(4000).select(F.concat(F.lit("http://h/"), "id").alias("url"), (F.col("id") % 2 == 0).alias("blocked"))
    assert 400 < urls.bounded(df, 500).count() < 600 and urls.bounded(df, 4000).count() == 4000


@pytest.mark.parametrize("texts, verdict", [(["http://a.com/", "http://b.com/"], "allow"), (["http://a.net/", "http://b.com/"], "block"),
                                            (["http://a.org/fr/", "http://b.com/"], "allow")])
def test_few_labels(spark, texts, verdict):
    got = {r["url"]: r["verdict"] for r in urls.judge(table(spark, texts)).collect()}
    assert got[texts[1]] == verdict
    assert result(urls.judge(table(spark, texts))) == sql(list(enumerate(texts)))


def test_empty_table_and_equal_urls(spark):
    assert urls.judge(table(spark, ["http://a.com"]).limit(0)).collect() == [] == sql([])
    got = urls.judge(table(spark, ["http://a.com/x"] * 3 + ["http://n.net/"] * 2)).collect()
    assert len(got) == 5 and len({(r["url"], r["verdict"], r["margin"]) for r in got}) == 2


def test_query_is_native_and_equals_its_sql(spark):
    df = urls.op11_boosted_urls(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "RDD"))
    rows = duckdb.sql(f"SELECT page_id, url FROM '{SF}/pages.parquet'").fetchall()
    assert result(df) == sql(rows)
