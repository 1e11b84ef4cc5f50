"""Spelling variants of words, found by sorting permuterm rotations.

A word is closed by a terminator and turned: `word$`, `ord$w`, `rd$wo`, ... Two words that differ by one replaced code point
have rotations that differ in the last code point only, and if a word lacks one code point of another, one of its rotations
is one of the other's without its last code point. So every pair of near words meets in the range of one prefix: the
rotation that ends in the edited code point, without it. Rotations are dealt by their beginning, which all of a prefix range
share, sorted, and scanned as they stream by. All that meet under one prefix differ in a single code point, so a range holds
no more words than the alphabet has letters; a word is told how many it met there and which is the most frequent, not all pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import settled

LETTERS = r"[A-Za-zÀ-ÿ]"
END = "$"
MIN_LENGTH, MIN_COUNT = 7, 2
# A near word is the form of a word that it outnumbers by this factor.
RATIO = 10
# Rotations of a longer word are known by their hashes, as their text would grow with the square of its length.
LONG = 256
HELD_WORDS = 300_000
CHUNK = 100_000


def _low(run: str) -> str:
    """A-Z in lower case, nothing else."""
    return run.lower() if run.isascii() else run.encode().lower().decode()


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int | None = None) -> DataFrame:
    """Rows (word, n): maximal runs of letters in `docs` (doc_id, text), A-Z in lower case, of at least `min_length` code
    points and `min_count` occurrences.

    With `damage`, a run loses a code point first if that number divides the crc32 h of `<doc_id>:<run>`: the one at
    h modulo its length. A NULL doc_id counts as ''. A NULL text has no words, repeated rows count each, texts are read whole.
    """
    runs = re.compile(LETTERS + "{%d,}" % min_length)  # a shorter run cannot become long enough

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                mine = Counter(runs.findall(_low(text)))
                if damage is None:
                    held.update(mine)
                else:
                    # equal runs of a document are damaged alike
                    begin = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                    for run, n in mine.items():
                        h = zlib.crc32(run.encode(), begin)
                        if h % damage == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < min_length:
                                continue
                        held[run] += n
                if len(held) > HELD_WORDS:
                    yield out()
        if held:
            yield out()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """Rows (rotation, n): all rotations of each word and its terminator, in the JVM."""
    twice = F.concat("word", F.lit(END), "word")
    turns = F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substr(twice, i, F.length("word") + 1))
    return words.select(F.explode(turns).alias("rotation"), "n")


def _column(values) -> pa.Array:
    return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


def _met(rows: pa.Table) -> pa.Table:
    """What words (word, n_near, near_n, near) learn from whole prefix ranges of sorted rotations."""
    rotation, n = _column(rows["rotation"]), _column(rows["n"])
    prefix = pc.utf8_slice_codeunits(rotation, 0, -1)
    edited = pc.utf8_slice_codeunits(rotation, -1)
    halves = pc.list_flatten(pc.split_pattern(rotation, END))
    at = np.arange(len(rotation)) * 2
    word = pc.binary_join_element_wise(halves.take(pa.array(at + 1)), halves.take(pa.array(at)), "")
    turned = pc.not_equal(edited, END)
    # of a run of equal code points only the first is taken out, so that a pair meets once
    first = pc.not_equal(pc.utf8_slice_codeunits(rotation, -2, -1), edited)
    ranges = prefix.filter(turned).dictionary_encode()
    short = pc.index_in(rotation, value_set=ranges.dictionary)  # the word that lacks the edited code point
    held = pa.table({"range": ranges.indices, "word": word.filter(turned), "n": n.filter(turned), "first": first.filter(turned)})
    without = pa.table({"range": short, "word": word, "n": n}).filter(pc.is_valid(short))
    number = len(ranges.dictionary)
    size = np.bincount(held["range"].to_numpy(), minlength=number)
    shorter = np.full(number, -1)
    shorter[without["range"].to_numpy()] = np.arange(len(without))
    busy = (size > 1) | (shorter >= 0)
    held = held.filter(pa.array(busy[held["range"].to_numpy()]))
    held = held.sort_by([("range", "ascending"), ("n", "descending"), ("word", "ascending")])
    group, count, words = held["range"].to_numpy(), held["n"].to_numpy(), _column(held["word"])
    out = []

    def add(whose: pa.Array, near: np.ndarray, best_n: np.ndarray, best: pa.Array) -> None:
        out.append(pa.table([_column(whose), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()), _column(best)], names=["word", "n_near", "near_n", "near"]))

    def heads(group: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)

    # replaced: all words of a range but the word itself, of which the first or the second is the most frequent
    start = heads(group)
    top = np.repeat(start, np.diff(np.r_[start, len(group)]))
    best = np.where(np.arange(len(group)) == top, top + 1, top)
    several = np.flatnonzero(size[group] > 1)
    best = best[several]
    add(words.take(pa.array(several)), size[group[several]] - 1, count[best], words.take(pa.array(best)))
    # inserted or deleted
    mine = np.flatnonzero(_column(held["first"]).to_numpy(zero_copy_only=False) & (shorter[group] >= 0))
    other = shorter[group[mine]]
    other_words, other_n = _column(without["word"]), without["n"].to_numpy()
    add(words.take(pa.array(mine)), np.ones(len(mine), np.int64), other_n[other], other_words.take(pa.array(other)))
    start = heads(group[mine])
    best = mine[start]
    sizes = np.diff(np.r_[start, len(mine)])
    add(other_words.take(pa.array(other[start])), sizes, count[best], words.take(pa.array(best)))
    return pa.concat_tables(out)


def _scan(batches: Iterator[pa.RecordBatch], head: int) -> Iterator[pa.RecordBatch]:
    """Sorted rotations in chunks of whole ranges: rotations of one beginning stay together."""
    waiting: list[pa.Table] = []
    wanted = CHUNK
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(pa.Table.from_batches([batch]))
        if sum(map(len, waiting)) < wanted:
            continue
        rows = pa.concat_tables(waiting).combine_chunks()
        begin = pc.utf8_slice_codeunits(_column(rows["rotation"]), 0, head)
        code = begin.dictionary_encode().indices.to_numpy()
        cut = len(rows) - int(np.argmax(code[::-1] != code[-1])) if code[0] != code[-1] else 0
        if cut:
            yield from _met(rows.slice(0, cut)).to_batches()
        waiting, wanted = [rows.slice(cut)], max(CHUNK, 2 * (len(rows) - cut))
    if waiting:
        yield from _met(pa.concat_tables(waiting)).to_batches()


_MODULI = (2**61 - 1, 2**61 - 31)
_BASES = (1_000_003, 2_147_483_659)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per long word its rotations (`whole`), and their prefixes without the edited code point, as rolling hashes."""

    def turns(word: str) -> Iterator[tuple[str, bool]]:
        marks = [*map(ord, word), 0]  # the terminator is 0
        size = len(marks)
        keys: list[list[list[int]]] = []
        for base, m in zip(_BASES, _MODULI):
            upto, power = [0], [1]
            for c in marks:
                upto.append((upto[-1] * base + c + 1) % m)
                power.append(power[-1] * base % m)
            span = lambda i, j: (upto[j] - upto[i] * power[j - i]) % m  # noqa: E731, B023
            join = lambda i, j, k: (span(i, size) * power[k - j] + span(j, k)) % m  # noqa: E731, B023
            keys.append([[join(i, 0, i) for i in range(size)], [join(i + 1, 0, i) for i in range(size - 1)]])
        for i in range(size):
            yield f"{keys[0][0][i]:x}.{keys[1][0][i]:x}", True
        for i in range(size - 1):
            yield f"{keys[0][1][i]:x}.{keys[1][1][i]:x}", False

    for batch in batches:
        for word in batch.column("word").to_pylist():
            key, whole = zip(*turns(word))
            tag = hashlib.sha256(word.encode()).hexdigest()
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(whole), pa.array([tag] * len(key))], ["key", "whole", "tag"])


def _long_met(words: DataFrame) -> DataFrame:
    """The same for long words: those that share a hashed prefix are looked at themselves."""
    named = words.select(F.sha2(F.col("word").cast("binary"), 256).alias("tag"), "word", "n")
    keys = settled(words.select("word").mapInArrow(_hashed, "key string, whole boolean, tag string"), "long-rotations")
    a = keys.where("NOT whole").select("key", F.col("tag").alias("a"))
    pairs = a.join(keys.select("key", F.col("tag").alias("b")), "key").where("a <> b").select("a", "b")
    pairs = pairs.union(pairs.select("b", "a")).distinct()
    mine = named.select(F.col("tag").alias("a"), "word", "n")
    theirs = named.select(F.col("tag").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = pairs.join(mine, "a").join(theirs, "b").where(F.levenshtein("word", "near", 1) == 1)
    return pairs.select("word", F.lit(1).cast("bigint").alias("n_near"), "near_n", "near")


def neighbours(words: DataFrame, min_length: int = MIN_LENGTH, long: int = LONG) -> DataFrame:
    """Rows (word, n_near, near_n, near) for the words (word, n) that have near ones: how many, and the most frequent, ties
    to the smaller in code-point order. Words are unique, of at least `min_length` code points, none the terminator."""
    usual = rotations(words.where(F.length("word") <= long + 1))
    dealt = usual.repartition(F.substring("rotation", 1, min_length)).sortWithinPartitions("rotation")
    met = dealt.mapInArrow(lambda b: _scan(b, min_length), "word string, n_near long, near_n long, near string")
    # a pair of a usual and a long word differs in length by one: the words at the limit are in both lists
    above = _long_met(words.where(F.length("word") > long)).where(
        (F.length("word") > long + 1) | (F.length("near") > long + 1)
    )
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    met = met.unionByName(above).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return met.select("word", "n_near", (-F.col("best.n")).alias("near_n"), "best.near")


def variants(words: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH, long: int = LONG) -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root), one per word (word, n): near words, the form (the most frequent near word,
    if it has `ratio` times the word's occurrences) and the root, which is where forms lead to.

    `ratio` is 2 or more. No words give no rows. Each step to a form multiplies the occurrences, so chains are short and their greatest length
    is known from the greatest count: roots are found by that many doublings of the step.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words: give a ratio of 2 or more")
    words = settled(words, "words")
    near = neighbours(words, min_length, long).withColumnRenamed("word", "_word")
    told = F.col("near_n") >= F.col("n") * ratio
    rows = words.join(near, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(told, F.col("near")).alias("form"), F.when(told, F.col("near_n")).alias("form_n"),
    )
    rows = settled(rows, "forms")
    most = words.agg(F.max("n").alias("n")).first()["n"] or 1
    steps = math.ceil(math.log2(1 + math.log(most, ratio)))
    roots = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(steps):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = settled(roots.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    rows = rows.join(roots.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    return rows.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
