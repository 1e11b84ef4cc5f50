import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pulsekit.llm import quality
from tests.llm.conftest import ODD, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_statistics_against_brute_force():
    rng = random.Random(1)
    texts = [r[1] for r in ODD] + ["".join(rng.choice("ab #*é\n\t\x0b\x1c |") for _ in range(rng.randrange(80))) for _ in range(400)]
    for t in texts:
        assert quality._statistics(None if t is None else t.encode())[:5] == brute(t), repr(t)[:200]


def test_forest_splits_rare_rows_off():
    rng = np.random.default_rng(2)
    x = np.vstack([rng.uniform(0, 0.01, (400, 3)), rng.uniform(0.5, 1, (12, 3))])
    good = np.arange(412) < 400
    forest = quality.grow(x, good)
    s = forest.scores(x)
    assert s[good].max() < s[~good].min()
    limit = quality.calibrate(s, good)
    assert ((s < limit) == good).all()
    assert quality.calibrate(s, np.ones(412, bool)) == float("inf")


def test_judge(spark, words):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(240):
        text = sentence(rng, words, 120)
        bad = i % 6 == 0
        if bad:
            text = " ".join(w + "$$$" for w in text.split()) if i % 12 else text.upper().replace(" ", "!! ")
        rows.append((i, text))
        marks.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([m for m in marks if m[0] % 2 == 0], "doc_id long, quality int, toxic int")
    forest = quality.fit(docs, labels)
    got = {r.doc_id: r.verdict.kept for r in quality.judge(docs, forest).select("doc_id", "verdict").collect()}
    assert sum(got[i] != bool(q) for i, q, _ in marks) <= 2


def test_odd_rows(odd, none, no_labels):
    forest = quality.fit(odd, no_labels)
    assert forest is None
    got = quality.judge(odd, forest)
    assert got.columns == [*odd.columns, "verdict_"] and got.count() == len(ODD)
    for r in got.select("doc_id", "text", "verdict_").collect():
        v = r.verdict_
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words) == brute(r.text)
        assert v.base_failed == (v.n_words < 50 or 100 * v.n_repeat_words > 50 * v.n_words) and v.kept == (not v.base_failed)
    assert quality.judge(none, quality.fit(none, no_labels)).where(F.col("verdict.kept")).count() == 0
