import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsekit.llm import packing
from tests.llm.conftest import ODD, sentence


@pytest.fixture(scope="module")
def reference():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return lambda text: made.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizers_library(reference):
    encode = packing.encoder(packing.vocabulary_path())
    rng = random.Random(8)
    pieces = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", " ", " ", "'s", "'LL", "'", "12", "٣", "!?", "_", "😀", "<|endoftext|>", "語"]
    texts = [r[1] or "" for r in ODD] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(3000)]
    assert [t for t in texts if encode(t) != reference(t)] == []


def test_differencing_is_near_equal():
    rng = random.Random(1)
    lengths = [rng.randrange(100, 257) for _ in range(900)]
    made = packing.difference(lengths, 80)
    assert sorted(i for w in made for i in w) == list(range(900)) and len(made) == 80
    sums = [sum(lengths[i] for i in w) for w in made]
    assert max(sums) - min(sums) <= 0.02 * max(sums)
    assert packing.difference([], 3) == [] and packing.difference([5], 3) == [[0]]
    # 8, 7, 6, 5, 4 by hand: 8 and 7 apart, 6 joins neither, then 6 5 4 against the imbalance
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2)) == [14, 16]


def test_window_count_rises_until_all_fit():
    rng = random.Random(2)
    for _ in range(200):
        lengths = [rng.randrange(1, 101) for _ in range(rng.randrange(1, 30))]
        made = packing.windows_of(lengths, 100)
        assert sorted(i for w in made for i in w) == list(range(len(lengths)))
        assert max(sum(lengths[i] for i in w) for w in made) <= 100


def test_cuts_move_until_windows_fit():
    rng = random.Random(3)
    risen = 0
    for _ in range(300):
        lengths, starts, joined = [], [], []
        for _ in range(rng.randrange(1, 12)):
            at = rng.randrange(50)
            for k in range(n := rng.randrange(1, 5)):
                lengths.append(rng.randrange(1, 60))
                starts.append(at)
                joined.append(k < n - 1)
                at += lengths[-1]
        old, ends, total = list(lengths), [s + n for s, n in zip(starts, lengths)], sum(lengths)
        made = packing.windows_of(lengths, 100, starts, joined)
        assert sorted(i for w in made for i in w) == list(range(len(lengths))) and sum(lengths) == total
        assert max(sum(lengths[i] for i in w) for w in made) <= 100 and min(lengths) > 0
        for i, on in enumerate(joined):
            assert starts[i] + lengths[i] == (starts[i + 1] if on else ends[i])
        assert all(lengths[i] == old[i] for i in range(len(old)) if not joined[i] and (i == 0 or not joined[i - 1]))
        risen += len(made) > -(-total // 100)
    assert 0 < risen < 200  # where moving cuts is not enough, the window count rises


def checked(df, rows, reference):
    """Every id in one piece, sequences without gaps and within the capacity; gives the sequences' lengths."""
    got = df.collect()
    spans, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        spans[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, text in rows:
        ids = np.array([*reference(text or ""), 1], "<u4")
        at = 0
        for r in sorted(spans[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.CAPACITY and {r.sequence_tokens for r in s} == {at}
    return [s[0].sequence_tokens for s in sequences.values()]


def test_pack(spark, words, reference):
    rng = random.Random(6)
    rows = [(i, sentence(rng, words, rng.choice([1, 20, 300, 300, 900, 4000]))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    lengths = checked(packing.pack(df), rows, reference)
    assert 1 - sum(lengths) / (packing.CAPACITY * len(lengths)) < 0.005


def test_odd_rows(odd, none, reference):
    unique = odd.dropDuplicates(["doc_id"])
    lengths = checked(packing.pack(unique), [tuple(r) for r in unique.select("doc_id", "text").collect()], reference)
    assert lengths
    twice = packing.pack(odd.where("doc_id = 5")).groupBy("start").count().collect()
    assert {r["count"] for r in twice} == {2}
    assert packing.pack(none).count() == 0


def test_added_tokens_as_the_library_does_by_default(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    default = lambda text: library.encode(text, add_special_tokens=False).ids
    assert default("a<|endoftext|>b") == [64, 50256, 65]
    encode = packing.encoder(packing.vocabulary_path(), packing.added_tokens())
    rng = random.Random(9)
    pieces = ["<|endoftext|>", "<|endoftext|>", "<|endof", "|>", "a", "é", " ", "  ", "\n", "'s", "12", "!?", "😀"]
    texts = ["", "<|endoftext|>"] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(20))) for _ in range(2000)]
    assert [t for t in texts if encode(t) != default(t)] == []
    rows = list(enumerate(texts[:200]))
    checked(packing.pack(spark.createDataFrame(rows, "doc_id long, text string")), rows, default)
