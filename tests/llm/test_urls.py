import random

import pytest
from pyspark.sql import functions as F

from pulsekit.llm import urls

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, rest = rest[:n], rest[n:]
    path = rest[: next((i for i, c in enumerate(rest) if c in "?#"), len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


@pytest.mark.parametrize("share", [0, 3, 50, 100])
def test_cascade_is_exact(spark, share):
    keys = spark.range(3000).select(F.concat(F.lit("key "), "id").alias("key"), (F.col("id") % 100 < share).alias("listed"))
    cascade = urls.build(keys.unionAll(keys.limit(100)).unionAll(spark.createDataFrame([(None, True)], "key string, listed boolean")))
    assert keys.where(cascade.listed(F.col("key")) != F.col("listed")).count() == 0
    assert spark.range(1).select(cascade.listed(F.lit(None).cast("string")).alias("x")).first().x is False
    if 0 < share < 100:
        assert len(cascade.parts[0]) > 1


def test_small_filters_need_more_levels(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 2)
    keys = spark.range(2000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 3 == 0).alias("listed"))
    cascade = urls.build(keys)
    assert len(cascade.parts[0]) > 3 and keys.where(cascade.listed(F.col("key")) != F.col("listed")).count() == 0


def test_a_long_list_is_split(spark):
    """Beyond the words one filter may have, parts of the keys get filters of their own, as exact as one."""
    keys = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = urls.build(keys, max_words=16)
    assert len(cascade.parts) == 5 and all(len(level.words) <= 24 for levels in cascade.parts for level in levels)
    assert keys.where(cascade.listed(F.col("key")) != F.col("listed")).count() == 0


def test_long_urls_and_odd_columns(spark):
    long = "https://" + "a" * 200_000 + ".example.com/en/" + "b" * 200_000
    rows = [(1, long, "x"), (1, long, "x"), (2, None, None), (None, "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, `judged` string")
    got = urls.judge(pages, RULES, urls.build(spark.createDataFrame([], "key string, listed boolean"))).select("page_id", "judged_.*").collect()
    assert sorted((str(r.page_id), len(r.host), len(r.path), r.rule, r.verdict) for r in got) == sorted(
        [("1", 200_012, 200_004, "example.com/en/", "block")] * 2 + [("2", 0, 0, None, "allow"), ("None", 0, 0, None, "allow")], key=str
    )


def test_judge(spark):
    rng = random.Random(1)
    parts = ["http", "://", "www.", "example.", "com", "net", "NET", "/", "/en/", "/es/", "?", "#", "x", "\n", "a.b", "É"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for i in range(1500)]
    rows += [(-1, None), (-2, "https://www.example.com/en/x?q"), (-3, "https://m.example.com/en/"), (-4, "http://com"), (-5, "http://com/"), (-2, "https://www.example.com/en/x?q")]
    pages = spark.createDataFrame([(*r, 1, "r") for r in rows], "page_id long, url string, judged int, rule string")
    hosts = pages.select(urls.host(F.col("url")).alias("key")).distinct().withColumn("listed", F.col("key").contains("x"))
    got = urls.judge(pages, RULES, urls.build(hosts))
    assert got.columns == ["page_id", "url", "judged", "rule", "judged_"]
    seen = sorted((r.page_id, r.url or "", *r.judged_) for r in got.collect())
    want = []
    for i, url in rows:
        host, path = plain(url)
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "block" if "x" in host else "allow"))
        want.append((i, url or "", host, path, rule, verdict))
    assert [tuple(map(str, r)) for r in seen] == [tuple(map(str, r)) for r in sorted(want, key=lambda r: (r[0], r[1]))]


def test_empty_tables_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    cascade = urls.build(spark.createDataFrame([], "key string, listed boolean"))
    assert cascade.parts == [[]] and urls.judge(none, RULES, cascade).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert urls.judge(one, [], cascade).first().judged == ("a.com", "/", None, "allow")
