"""URL verdicts from host rules and a cascade of Bloom filters, in DataFrame functions only.

The cascade encodes which keys of a known universe are listed: level 0 holds the listed keys, level 1 the other keys of
the universe that level 0 takes for listed, level 2 the listed keys that level 1 takes for others, and so on until no key
is mistaken. A key of the universe is looked up by its own bits: the first level that does not hold it decides, exactly
and without a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import free_name, settled

BITS_PER_KEY = 10
HASHES = 7
# Words of 64 bits one level may have; a longer list is split by hash of the key into several cascades.
MAX_WORDS = 1 << 20
MAX_LEVELS = 40


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for NULL or without `://`."""
    return _lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty for NULL or without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest (verdict, host, path) rule that fits, as a struct (length, rule, verdict); NULL if none does.

    A rule fits its host and all subdomains, for paths that start with its own. The list is part of the plan.
    """
    if not rules:
        return F.lit(None).cast("struct<length: int, host_length: int, rule: string, verdict: string>")
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(
                F.lit(len(h) + len(p)).alias("length"),
                F.lit(len(h)).alias("host_length"),
                F.lit(h + p).alias("rule"),
                F.lit(verdict).alias("verdict"),
            ),
        )
        for verdict, h, p in rules
    ]
    return F.array_max(F.array(*fits))


@dataclass
class Level:
    words: list[int]

    def holds(self, key: Column, level: int) -> Column:
        """Are all bits of the key set?"""
        if not self.words:
            return F.lit(False)
        # one text that the optimizer folds into an array
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        set_ = lambda bit: _right(F.get(words, _right(bit, F.lit(6)).cast("int")), bit.bitwiseAND(F.lit(63)))
        return F.forall(F.array(*_bits(key, level, len(self.words))), lambda bit: set_(bit).bitwiseAND(F.lit(1)) == 1)


def _right(value: Column, by: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, by.cast("int"))


def _bits(key: Column, level: int, words: int) -> list[Column]:
    """Positions of a key's bits: two hashes, combined."""
    a, b = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))
    n = F.lit(words * 64).cast("bigint")
    step = F.pmod(b, n)
    return [F.pmod(F.pmod(a, n) + step * k, n) for k in range(HASHES)]


def _words(count: int) -> int:
    return max(1, -(-count * BITS_PER_KEY // 64))


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))


def _level(keys: DataFrame, number: int, count: int) -> Level:
    """Bits of `keys` (column key), gathered as one array of 64-bit words."""
    size = _words(count)
    bits = keys.select(F.explode(F.array(*_bits(F.col("key"), number, size))).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))
    words = bits.groupBy(_right(F.col("bit"), F.lit(6)).alias("word")).agg(F.bit_or(one).alias("bits"))
    found = dict(words.collect())
    return Level([found.get(w, 0) for w in range(size)])


@dataclass
class Cascade:
    """Levels for each part of the keys; the plan holds all of them, so it grows with the list, ten bits a key."""

    parts: list[list[Level]]

    def listed(self, key: Column) -> Column:
        """Is a key of the universe listed? NULL keys are not."""
        answer = F.lit(False)
        for n, levels in enumerate(self.parts):
            here = F.lit(len(levels) % 2 == 1)
            for number in range(len(levels) - 1, -1, -1):
                # not held by an even level: not listed; not held by an odd one: listed
                here = F.when(levels[number].holds(key, number), here).otherwise(F.lit(number % 2 == 1))
            answer = here if len(self.parts) == 1 else F.when(_part(key, len(self.parts)) == n, here).otherwise(answer)
        return answer & key.isNotNull()


def build(universe: DataFrame, max_words: int = MAX_WORDS) -> Cascade:
    """From the whole universe of keys: rows (key, listed). Repeated keys count once and are listed if any row says so;
    NULL keys are left out. An empty universe, or one without listed keys, gives a cascade that lists nothing. A list whose
    first level would take more than `max_words` is split by hash, and every part gets a cascade of its own."""
    keys = universe.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed"))
    keys = settled(keys, "keys")
    count = keys.where("listed").count()
    parts = max(1, -(-_words(count) // max_words))
    if parts == 1:
        return Cascade([_levels(keys, count)])
    made = []
    for n in range(parts):
        mine = keys.where(_part(F.col("key"), parts) == n)
        made.append(_levels(mine, mine.where("listed").count()))
    return Cascade(made)


def _levels(keys: DataFrame, count: int) -> list[Level]:
    levels: list[Level] = []
    # `inside`: keys the next level must hold; `outside`: keys it should not hold
    inside, outside = keys.where("listed"), keys.where("NOT listed")
    for number in range(MAX_LEVELS):
        if not count:
            return levels
        levels.append(_level(inside, number, count))
        wrong = settled(outside.where(levels[-1].holds(F.col("key"), number)), "mistaken")
        inside, outside = wrong, inside
        count = inside.count()
    raise RuntimeError("the cascade did not end")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], cascade: Cascade) -> DataFrame:
    """`pages` with a struct column `judged` (a free name): host, path, rule and verdict (allow or block).

    The longest fitting rule decides; without one a page is blocked if the cascade lists its host. A NULL url, or one
    without `://`, has empty host and path, fits no rule and is looked up like any other. Rules of equal length are settled by
    the longer host, then by text. Repeated rows are judged each, and a url counts whole, however long.
    """
    url, name = F.col("url"), free_name(pages, "judged")
    parts = pages.withColumn(name, F.struct(host(url).alias("host"), path(url).alias("path")))
    h, p = F.col(f"{name}.host"), F.col(f"{name}.path")
    rule = free_name(parts, "rule")
    parts = parts.withColumn(rule, matched_rule(h, p, rules))
    verdict = F.coalesce(F.col(f"{rule}.verdict"), F.when(cascade.listed(h), F.lit("block")).otherwise(F.lit("allow")))
    judged = F.struct(h.alias("host"), p.alias("path"), F.col(f"{rule}.rule").alias("rule"), verdict.alias("verdict"))
    return parts.select(*[c for c in pages.columns], judged.alias(name))
