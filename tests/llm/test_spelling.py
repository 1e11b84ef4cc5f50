import random
import re
import zlib
from collections import Counter

import pytest

from pulsekit.llm import spelling


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, damage, min_length=7, min_count=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def brute(words, ratio=10):
    forms = {}
    for w, n in words.items():
        mine = sorted((-m, v) for v, m in words.items() if near(w, v))
        told = bool(mine) and -mine[0][0] >= ratio * n
        forms[w] = (n, len(mine), mine[0][1] if told else None, -mine[0][0] if told else None)
    out = {}
    for w in words:
        root = w
        while forms[root][2]:
            root = forms[root][2]
        out[w] = (*forms[w], root)
    return out


def got(frame):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect()}


def texts(seed, n=300):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé\xd7") for _ in range(rng.randrange(6, 10))) for _ in range(40)]
    made = []
    for i in range(n):
        some = []
        for _ in range(rng.randrange(0, 40)):
            w = stems[min(int(rng.paretovariate(0.6)), len(stems)) - 1]
            if rng.random() < 0.2:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "éb", "B"]) + w[at + rng.randrange(2) :]
            some.append(w if rng.random() < 0.9 else w.upper())
        made.append((i, " ".join(some)))
    return made


@pytest.mark.parametrize("damage", [31, 3, None])
def test_words_and_variants(spark, damage):
    rows = texts(damage or 0) + [(None, "aaaaaaaa aaaaaaaa aaaaaaab"), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = spelling.words(docs, damage=damage)
    want = brute_words(rows, damage)
    assert {r.word: r.n for r in words.collect()} == want
    assert got(spelling.variants(words)) == brute(want)


def test_runs_of_equal_letters_meet_once(spark):
    words = {"aaaaaaa": 5, "aaaaaaaa": 90, "aaaaaaaaa": 2000, "abaaaaa": 5, "aaaaaaab": 900, "aabaaaaa": 900}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.variants(frame)) == brute(words)


def test_ties_and_chains(spark):
    words = {"wordsss": 1, "wordss\xff": 10, "wordssa": 10, "wordsaa": 100, "wordaaa": 1000, "woraaaa": 10_000, "woaaaaa": 10**6, "alonely": 2}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = got(spelling.variants(frame))
    assert found == brute(words)
    assert found["wordsss"][2] == "wordssa" and found["wordsss"][4] == "woaaaaa"


@pytest.mark.parametrize("long", [8, 9, 20])
def test_long_words(spark, long):
    """Long words are matched through hashes of their rotations, and with the words at the limit."""
    rng = random.Random(long)
    words = {}
    for _ in range(25):
        w = "".join(rng.choice("ab") for _ in range(rng.randrange(7, 12)))
        words[w] = rng.choice([2, 3, 40, 700])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.variants(frame, long=long)) == brute(words)


def test_a_very_long_word(spark):
    a = "x" + "yz" * 10_000
    words = {a: 3, a[:5000] + a[5001:]: 50, a[:-1] + "q": 2, "unrelated": 4}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.variants(frame)) == brute(words)


def test_chunks(spark, monkeypatch):
    words = brute_words(texts(9), None, 4, 1)
    rows = spelling.rotations(spark.createDataFrame(list(words.items()), "word string, n long")).orderBy("rotation").toArrow()
    whole = spelling._met(rows).to_pylist()
    monkeypatch.setattr(spelling, "CHUNK", 50)
    parts = [r for b in spelling._scan(iter(rows.to_batches(max_chunksize=17)), 4) for r in b.to_pylist()]
    key = lambda r: tuple(map(str, r.values()))
    assert sorted(parts, key=key) == sorted(whole, key=key)


def test_odd_rows(spark, odd, none):
    assert spelling.variants(spelling.words(none, damage=31)).count() == 0
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = got(spelling.variants(spelling.words(odd, damage=31)))
    assert found == brute(brute_words(rows, 31))


def test_ratio():
    with pytest.raises(ValueError):
        spelling.variants(None, ratio=1)
