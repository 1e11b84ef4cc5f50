import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulsekit.llm import divergence


def brute(rows, min_docs=3, top=200):
    docs, counts, groups = Counter(), {}, {}
    for lang, source, text in rows:
        key = (lang or "", source or "")
        groups.setdefault(key[0], set()).add(key[1])
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts.setdefault(key, Counter()).update(terms)
        docs.update((key[0], t) for t in set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for (g, t), n in docs.items() if g == lang and n >= min_docs)
        v = len(kept)
        own = {s: [counts[lang, s][t] for t in kept] for s in sources}
        p = {s: [1 + 10**9 * (c + 1) // (sum(cs) + v) for c in cs] for s, cs in own.items()}
        all_ = [sum(c) for c in zip(*own.values())]
        q = [1 + 10**9 * (c + 1) // (sum(all_) + v) for c in all_]
        for s in sources:
            pairs = [(-sum((a - b) ** 2 // b for a, b in zip(p[s], p[o])), o.encode()) for o in sources - {s}]
            best = [(-((a - b) ** 2 // b), t.encode()) for a, b, t, c in zip(p[s], q, kept, own[s]) if c and a > b]
            for part, found, most in (("pair", pairs, None), ("term", best, top)):
                out |= {(lang, s, part, i.decode(), -f, r + 1) for r, (f, i) in enumerate(sorted(found)[:most])}
    return out


def got(frame):
    rows = [tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"{rng.choice('abÀß日')}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for _ in range(n):
        source = rng.choice(["a", "b", "B", None, "é"])
        bias = hash(source) % 7 if source else 3
        text = " ".join(rng.choice([w, w.upper(), w + "1" + w]) for w in (words[(int(rng.paretovariate(0.5)) * (1 + bias)) % 300] for _ in range(rng.randrange(30))))
        rows.append((rng.choice(["en", "de", None]), source, rng.choice([text, text, text, None, ""])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_audit(spark, monkeypatch, seed):
    rows = corpus(seed) + [("xx", "only", "one two three"), ("yy", "p", "x"), ("yy", "q", None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    want = brute(rows)
    assert got(divergence.audit(docs)) == want
    assert got(divergence.audit(docs, top=3)) == brute(rows, top=3)
    # small blocks of terms and slices of texts give the same
    monkeypatch.setattr(divergence, "SLICE_BYTES", 300)
    monkeypatch.setattr(divergence, "HELD_ROWS", 50)
    assert got(divergence.audit(docs, cells=20)) == want


def test_odd_rows(spark, odd, none):
    assert divergence.audit(none).count() == 0
    rows = [(r.lang, r.source, r.text) for r in odd.select("lang", "source", "text").collect()]
    assert got(divergence.audit(odd)) == brute(rows)
    assert got(divergence.audit(odd, min_docs=1)) == brute(rows, min_docs=1)


def test_weights_of_very_frequent_terms():
    rng = random.Random(3)
    for _ in range(300):
        total = rng.choice([1, 2, 10**6, 10**12, 8 * 10**15]) + rng.randrange(100)
        count = rng.randrange(total)
        assert int(divergence.weight(np.array([count]), total)[0]) == 1 + 10**9 * (count + 1) // total


def test_a_term_with_many_partial_rows():
    part = pa.table([["en"] * 4000, ["a"] * 2500 + ["b"] * 1500, ["the"] * 4000, [1] * 4000, [1] * 4000], schema=divergence._PARTIAL)
    more = pa.table([["en"], ["b"], ["then"], [5], [2]], schema=divergence._PARTIAL)
    rows = pa.concat_tables([part, more])
    kept = [r for b in divergence._keep(iter(rows.to_batches(max_chunksize=300)), 3) for r in b.to_pylist()]
    assert kept == [{"lang": "en", "term": "the", "sources": ["a", "b"], "counts": [2500, 1500]}]
