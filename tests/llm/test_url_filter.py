"""Url filters against a plain version, and the cascade against set membership."""

import random
import re

from pyspark.sql import functions as F

from callsheet.llm.queries import ORACLE_SQL, URL_RULES
from callsheet.llm.url_filter import Cascade, bloom_cascade, judge_urls, rule_table


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3:]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(len(h + p), len(h), h + p, v == "block") for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], default if best is None else "block" if best[3] else "allow"


URLS = [None, "", "no scheme", "://", "http://", "http:///en/", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/x?a=b", "http://example.com/EN/", "http://xexample.com/en/", "https://a.example.com/en/",
        "https://a.www.example.com/en/#t", "ftp://a.net/es/", "http://net/fr/y", "http://net.com/fr/", "http://a.net?/es/", "http://a.net#/fr/", "http://a..net/fr/", "http://.com/", "http://com./", "a://b://c.com/d",
        "http://example.com:80/en/", "http://ÀÉ.com/ü/", "x\n://y.com/\n/z", "http://" + "a." * 3000 + "com/" + "p/" * 5000, "http://example.com/en/"]


def judged(df, rules, **names):
    return sorted((tuple(r) for r in judge_urls(df, rules, **names).collect()), key=repr)


def test_judged_like_the_plain_version(spark):
    table = [*enumerate(URLS), (None, URLS[8]), (3, URLS[3])]
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in table], "page_id long, url string, host string, rule int").repartition(3)
    assert judged(df, rule_table(spark, URL_RULES)) == sorted(((i, *plain(u, URL_RULES)) for i, u in table), key=repr)
    assert judged(df.limit(0), rule_table(spark, URL_RULES)) == []
    none = rule_table(spark, URL_RULES).limit(0)
    assert {r[3:] for r in judged(df, none)} == {(None, "allow")}


def test_many_rules(spark):
    rng = random.Random(11)
    hosts = [".".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    paths = ["", *["/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 5))) for _ in range(100)]]
    rules = list({(h, p): v for h, p, v in ((rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(300))}.items())
    rules = [(h, p, v) for (h, p), v in rules] + [("a.b", "/x", "allow"), ("a.b", "/x", "block")]
    rules = [r for r in rules if r[:2] != ("a.b", "/x")] + rules[-2:]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['', '.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(paths)}" for _ in range(1500)] + ["http://a.b/x"]
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("b", None, "block"), ("c", "/", "other")], "host string, path string, verdict string")
    got = judged(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), table, default="block")
    assert got == sorted(((i, *plain(u, rules, "block")) for i, u in enumerate(urls)), key=repr)
    assert sum(r[3] is not None for r in got) > 300


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.filter(F.pmod(F.xxhash64("key"), F.lit(17)) == 0)
    cascade = bloom_cascade(listed.union(listed), keys.union(keys))
    assert len(cascade.levels) > 2
    got = {r.key for r in keys.filter(cascade.holds(F.col("key"))).collect()}
    assert got == {r.key for r in listed.collect()}
    assert bloom_cascade(listed.limit(0), keys) == Cascade(())
    assert keys.filter(Cascade(()).holds(F.col("key"))).count() == 0
    plan = keys.select(cascade.holds(F.col("key")).alias("held"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_query_equals_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    from callsheet.llm.queries import op12_url_filter

    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
        want = sorted(con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLE_SQL['op12_url_filter']})").fetchall(), key=repr)
    assert sorted((tuple(r) for r in op12_url_filter(spark, sf).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr) == want
