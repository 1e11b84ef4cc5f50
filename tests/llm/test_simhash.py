import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsekit.llm import simhash
from tests.llm.conftest import ODD, sentence


def plain_fingerprint(text, width=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def classes(points, distance):
    """Smallest point of each component, by comparing all pairs."""
    label = list(range(len(points)))
    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= distance:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def clustered(seed, n=160):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(8)]
    out = {rng.getrandbits(64) for _ in range(n // 4)}
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("distance", [0, 2, 4])
@pytest.mark.parametrize("cell_rows", [7, 50_000])
def test_links_against_all_pairs(spark, distance, cell_rows):
    points = clustered(distance + cell_rows)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = simhash.links(df, distance, cell_rows).collect()
    assert all(0 < bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= distance for r in found)
    want = classes(points, distance)
    place = {s: i for i, s in enumerate(signed)}
    label = list(range(len(points)))
    for r in found:
        a, b = label[place[r.a]], label[place[r.b]]
        label = [min(a, b) if x in (a, b) else x for x in label]
    assert label == want
    named = {r.node: r.label for r in simhash.connected(spark.createDataFrame(found, "a long, b long")).collect()}
    linked = [i for i in range(len(points)) if want.count(want[i]) > 1]
    assert set(named) == {signed[i] for i in linked}
    groups = {}
    for i in linked:
        groups.setdefault(want[i], set()).add(named[signed[i]])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {(r.label) for r in simhash.connected(edges).collect()} == {0}


def test_manhattan_bound_is_below_the_distance():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, 500).astype(np.uint64), rng.integers(0, 2**63, 500).astype(np.uint64)
    near = np.bitwise_count(simhash._sort_bits(a) ^ simhash._sort_bits(b))
    assert (near <= np.bitwise_count(a ^ b)).all()


def test_documents(spark, words):
    rng = random.Random(9)
    rows = []
    for i in range(40):
        base = sentence(rng, words, 200).split()
        for k in range(rng.randrange(1, 5)):
            copy = list(base)
            if k:
                copy[rng.randrange(200)] = "changed"
            rows.append((len(rows) * 3, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(simhash.near_duplicates(docs).collect())
    points = [plain_fingerprint(t) for _, t in rows]
    assert [r.fingerprint for r in got] == [f"{p:016x}" for p in points]
    want = classes(points, 4)
    assert [r.component_id for r in got] == [rows[w][0] for w in want]
    kept = simhash.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({rows[w][0] for w in want})


def test_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert sorted(r.fingerprint for r in got) == sorted(f"{plain_fingerprint(r[1]):016x}" for r in ODD)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    # 1, 2 and 3 are one group, the repeated rows another; the row without id is alone and stays
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8]
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0


def test_keep_one_with_a_map_column(spark):
    rows = [(1, "one two three", {"a": 1}), (2, "one two three", {"a": 1}), (2, "one two three", {"a": 1}), (3, "else", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [1, 3]
