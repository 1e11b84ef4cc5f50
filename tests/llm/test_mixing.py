import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulsekit.llm import mixing
from pulsekit.llm.common import word_count
from tests.llm.conftest import ODD, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, passes=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        level = {s: rest * w[s] / sum(w[f] for f in free) for s in free}
        over = [s for s in free if level[s] > passes * sizes[s] + 1e-9]
        if not over:
            return fixed | level
        fixed |= {s: passes * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 5, 1000, rng.randrange(100_000)]) for s in ["b", "a", "ä", "Z", "10", "9", None][: 3 + 2 * seed]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 500, "b": 200},  # proportional to the weights: both caps are met at one level
        {c: 100 for c in "abcdefg"},
        {"a": 0, "b": 0, None: 0},
        {"a": 1000},
        {"a": 5000, "b": 2000, "c": 1000, "d": 5000, "e": 10, None: 7},
        {"a": 1, "b": 1_000_000, "c": 1},
    ],
)
def test_targets_on_ties(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)
    assert abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 1e-6 * (1 + sum(sizes.values()))


def test_clashing_names_and_maps(spark):
    rows = [(i, "some words " * (i % 5), "s", i, 2, 3, 4, {"k": str(i), "l": "x"}) for i in range(40)]
    names = "doc_id long, text string, source string, t_tag long, t_size long, t_part int, t_n int, `a.b` map<string,string>"
    docs = spark.createDataFrame(rows, names)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.select(F.sum(word_count("text"))).first()[0] == mixing.mix(docs).select(F.sum("taken")).first()[0] > 0


def test_mix(spark, words):
    rng = random.Random(4)
    rows = [(i, sentence(rng, words, rng.randrange(1, 400)), rng.choice(["hot"] * 5 + ["a", "b", "c", None])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(docs, block=64).collect()}
    assert len(got) == 600
    sizes = Counter()
    for i, t, s in rows:
        assert got[i].size == len(WORD.findall(t)) and got[i].source == s
        sizes[s] += got[i].size
    want = plain_targets(sizes)
    taken = Counter()
    for r in got.values():
        assert 0 <= r.taken <= 2 * r.size and sum(r.parts) == r.taken
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * want[r.source]
        taken[r.source] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= max(4 * 64, 0.02 * want[s]), s
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(7), block=64).collect()}
    assert again == {i: r.taken for i, r in got.items()}
    mixed = mixing.mixed_documents(docs, block=64)
    assert mixed.columns == docs.columns
    words_of = Counter()
    for r in mixed.select("doc_id", word_count("text").alias("n")).collect():
        words_of[r.doc_id] += r.n
    assert words_of == Counter({i: r.taken for i, r in got.items() if r.taken})


def test_schedule_spreads_sources(spark):
    plan = spark.createDataFrame([("=a", "a", 1000, 750.0, 1000), ("=b", "b", 1000, 250.0, 1000)], "key string, source string, source_size long, target double, blocks long")
    slots = sorted(mixing.schedule(spark, plan).collect())
    assert [r.slot for r in slots] == list(range(1000))
    for key in ("=a", "=b"):
        assert [r["rank"] for r in slots if r.key == key] == list(range(sum(r.key == key for r in slots)))
    # in every stretch of 50 slots the shares hold to within two slots
    for i in range(0, 1000, 50):
        assert abs(sum(r.key == "=a" for r in slots[i : i + 50]) - 37.5) <= 2.5


def test_odd_rows(odd, none):
    got = mixing.mix(odd)
    rows = got.collect()
    assert len(rows) == len(ODD)
    assert Counter(r.size for r in rows) == Counter(len(WORD.findall(r[1] or "")) for r in ODD)
    assert all(r.taken <= 2 * r.size for r in rows)
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    n = mixed.select(F.sum(word_count("text"))).first()[0]
    assert n == sum(r.taken for r in rows)
    assert mixing.mix(none).count() == mixing.mixed_documents(none).count() == 0
