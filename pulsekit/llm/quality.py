"""Quality rules judged by an isolation forest.

Rule statistics of each document become shares that do not depend on its length, and of each share only what lies
beyond the range usual among rows labelled good counts: usual documents all lie at the origin. A forest of random splits,
grown on a bounded sample of labelled rows that pass the base rules, gives each document its mean path length: anomalous
documents are isolated after few splits. Ranges and the score above which a document goes are calibrated on the labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import free_name, settled, text_bytes

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Labelled rows, at most, from which the forest is grown and its threshold calibrated.
MAX_LABELLED = 8192
# Share of the rows labelled good that may lie beyond the usual range of a statistic, at either end, and how far the
# range is widened at both, in parts of its width: unseen good documents lie a little outside.
TAIL = 0.001
MARGIN = 0.5

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SHARES = ["symbol", "shout", "capital", "dup_line", "repeat", "word_length", "digit", "top_word"]
STATISTICS = ", ".join(f"{c}: bigint" for c in _COUNTS) + ", " + ", ".join(f"{c}_share: double" for c in _SHARES)


def _repeated(words: list[bytes]) -> tuple[int, int]:
    """Words inside 3-word windows that the text holds twice or more, and uses of the commonest word."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    top = int(np.bincount(ids).max())
    if len(words) < 4:  # a single window cannot come twice
        return 0, top
    pair = ids[:-1] * len(seen) + ids[1:]
    pair = np.unique(pair, return_inverse=True)[1] if len(seen) > 1_000_000 else pair
    window = pair[:-1] * len(seen) + ids[2:]
    _, inverse, count = np.unique(window, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[inverse] > 1)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum()), top


def _statistics(data: bytes | None) -> tuple:
    data = data or b""
    words = data.split()
    n = len(words)
    if not n:
        return (0,) * len(_COUNTS) + (0.0,) * len(_SHARES)
    of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = len(data) - int(of[0x80:0xC0].sum())  # continuation bytes are no code points of their own
    word_chars = chars - int(of[0x20] + of[0x09:0x0E].sum())
    symbols = int(sum(of[c] for c in SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.split(None, 1)]
    dup_lines = len(lines) - len(set(lines))
    repeated, top = _repeated(words)
    small, large = int(of[0x61:0x7B].sum()), int(of[0x41:0x5B].sum())
    shares = (
        symbols / n,
        int(of[0x21] + of[0x3F]) / n,
        large / max(1, small + large),
        dup_lines / max(1, len(lines)),
        repeated / n,
        word_chars / n,
        int(of[0x30:0x3A].sum()) / max(1, word_chars),
        top / n,
    )
    return (n, word_chars, symbols, dup_lines, repeated, *map(float, shares))


def _statistics_of(texts: pa.Array) -> pa.Array:
    columns = list(zip(*(_statistics(t.as_py()) for t in texts))) or [()] * (len(_COUNTS) + len(_SHARES))
    types = [pa.int64()] * len(_COUNTS) + [pa.float64()] * len(_SHARES)
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    return pa.StructArray.from_arrays(arrays, names=_COUNTS + [f"{s}_share" for s in _SHARES])


def rule_statistics(text: str = "text") -> Column:
    """Struct of counts and shares of a text; a NULL, empty or blank text counts zero everywhere."""

    def run(texts: pa.Array) -> pa.Array:
        return _statistics_of(texts)

    return F.arrow_udf(run, f"struct<{STATISTICS}>")(text_bytes(text))


@dataclass
class Forest:
    """Trees as flat arrays: node i of tree t splits on feature[t, i] below cut[t, i]; a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    sample: int
    usual: tuple[np.ndarray, np.ndarray]
    threshold: float = float("inf")

    def scores(self, shares: np.ndarray) -> np.ndarray:
        """Anomaly score 2 ** (-mean path length / usual path length) of each row of shares."""
        x = shares - np.clip(shares, *self.usual)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, child, depth in zip(self.feature, self.cut, self.child, self.depth):
            node = np.zeros(len(x), np.int64)
            while (inner := feature[node] >= 0).any():
                go = rows[inner]
                at = node[go]
                node[go] = child[at] + (x[go, feature[at]] >= cut[at])
            total += depth[node]
        return 2.0 ** (-total / len(self.feature) / _usual(self.sample))


def _usual(n: int) -> float:
    """Mean path length of an unsuccessful search among n values."""
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def grow(shares: np.ndarray, good: np.ndarray, trees: int = 100, sample: int = 64, seed: int = 7) -> Forest:
    """An isolation forest: each tree halves a random sample by random cuts of random features."""
    random = np.random.default_rng(seed)
    usual = np.quantile(shares[good] if good.any() else shares, [TAIL, 1 - TAIL], axis=0)
    usual = usual + np.array([[-MARGIN], [MARGIN]]) * (usual[1] - usual[0])
    x = shares - np.clip(shares, *usual)
    sample = min(sample, len(x))
    limit = int(np.ceil(np.log2(max(2, sample))))
    size = 2 ** (limit + 2)
    feature, child = np.full((trees, size), -1), np.zeros((trees, size), np.int64)
    forest = Forest(feature, np.zeros((trees, size)), child, np.zeros((trees, size)), sample, tuple(usual))
    for t in range(trees):
        waiting, used = [(0, random.choice(len(x), sample, replace=False), 0)], 1
        while waiting:
            node, rows, depth = waiting.pop()
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth == limit or len(rows) < 2 or not len(usable):
                forest.depth[t, node] = depth + _usual(len(rows))
                continue
            f = random.choice(usable)
            cut = random.uniform(low[f], high[f])
            right = x[rows, f] >= cut
            forest.feature[t, node], forest.cut[t, node], forest.child[t, node] = f, cut, used
            waiting += [(used, rows[~right], depth + 1), (used + 1, rows[right], depth + 1)]
            used += 2
    return forest


def calibrate(scores: np.ndarray, good: np.ndarray) -> float:
    """The score from which on documents go: fewest labelled rows judged wrongly, a lost good row counting double."""
    if good.all() or not len(good):
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    s, g = scores[order], good[order]
    gain = np.cumsum(np.where(g, -2, 1))
    gain[:-1][s[:-1] == s[1:]] = -len(s)  # equal scores go together
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return float("inf")
    return float((s[best] + s[best + 1]) / 2) if best + 1 < len(s) else float(s[best])


def base_failed(s: str = "s"):
    return (F.col(f"{s}.n_words") < MIN_WORDS) | (
        F.col(f"{s}.n_repeat_words") * 100 > F.col(f"{s}.n_words") * MAX_REPEAT_PERCENT
    )


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Forest | None:
    """Grow and calibrate on at most `max_labelled` labelled documents (by hash of doc_id) that pass the base rules.

    None if no labelled document does: then the base rules alone decide. Labels other than 0 and 1, and NULL, are ignored.
    """
    chosen = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    # At most max_labelled rows of two numbers. What they choose is written: a condition on statistics would otherwise be
    # drawn below the join, and the statistics of all documents with it.
    mine = settled(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    rows = mine.select("doc_id", "good", rule_statistics().alias("s"))
    rows = rows.where(~base_failed()).groupBy("doc_id").agg(F.min(F.struct("good", "s")).alias("r"))
    sample = rows.select("doc_id", "r.good", *[f"r.s.{c}_share" for c in _SHARES]).orderBy("doc_id").toPandas()
    if not len(sample):
        return None
    x, good = sample.iloc[:, 2:].to_numpy(float), sample["good"].to_numpy() == 1
    forest = grow(x, good)
    forest.threshold = calibrate(forest.scores(x), good)
    return forest


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """`docs` with a struct column `verdict` (a free name): statistics, base_failed, anomaly (score) and kept.

    Repeated rows are judged each; a NULL or empty text fails the base rules.
    """
    name = free_name(docs, "verdict")

    @F.arrow_udf("double")
    def anomaly(*shares: pa.Array) -> pa.Array:
        x = np.stack([np.asarray(s.to_numpy(zero_copy_only=False), float) for s in shares], axis=1)
        return pa.array(forest.scores(x) if forest is not None else np.zeros(len(x)))

    temp = free_name(docs, "s")
    out = docs.withColumn(temp, rule_statistics())
    score = free_name(out, "anomaly")
    out = out.withColumn(score, anomaly(*[F.col(f"{temp}.{c}_share") for c in _SHARES]))
    failed = base_failed(temp)
    limit = forest.threshold if forest is not None else float("inf")
    kept = ~failed & (F.col(score) < F.lit(limit))
    fields = [F.col(f"{temp}.{c}").alias(c) for c in _COUNTS]
    verdict = F.struct(*fields, failed.alias("base_failed"), F.col(score).alias("anomaly"), kept.alias("kept"))
    return out.select(*docs.columns, verdict.alias(name))
