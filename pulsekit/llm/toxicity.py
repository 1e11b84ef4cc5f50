"""Toxicity by weak supervision.

Lexicon entries, words and word beginnings, are mined from labelled rows; each is a voter that speaks or keeps silent
about a document. A generative model of the hidden label estimates how often each voter speaks about toxic and about
other documents, and how far voters repeat each other: the correlation of what their votes leave unexplained lowers their
weight. A linear classifier over the lexicon entries is then trained on the posterior labels, and scores every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import free_name, settled

# Labelled rows, at most, from which lexicons and weights are learned.
MAX_LABELLED = 8192
MAX_LEXICON = 1500
# Lexicon entries are whole words and beginnings of these lengths.
BEGINNINGS = (4, 5, 6, 7)
_WORDS = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> set[str]:
    """The words of a text in lower case (marked "=") and their beginnings (marked by length)."""
    words = set(_WORDS.findall((text or "").lower()))
    found = {f"={w}" for w in words}
    for n in BEGINNINGS:
        found.update(f"{n}{w[:n]}" for w in words if len(w) >= n)
    return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        at, weights = self.bias, self.weights
        words = set(_WORDS.findall((text or "").lower()))
        # summed in the order of the entries, so that reruns agree to the last digit
        hit = {k for w in words for k in (f"={w}", *(f"{n}{w[:n]}" for n in BEGINNINGS if len(w) >= n)) if k in weights}
        for k in sorted(hit):
            at += weights[k]
        return float(1 / (1 + np.exp(-np.clip(at, -30, 30))))


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 5, prior: float = 50.0) -> np.ndarray:
    """Posterior of the hidden label of each row of votes (1: the voter speaks, 0: it keeps silent, which says nothing).

    Starts from the labels and repeats: how often each voter speaks in either class (pulled to what the labels say),
    correlations of the votes this leaves unexplained, posteriors from votes weighted by the inverse of the correlation
    they share. The last voter speaks when all others are silent.
    """
    votes = np.hstack([votes, 1 - votes.max(axis=1, keepdims=True, initial=0)])
    y = labels.astype(float)
    rates = lambda t: ((votes * t[:, None]).sum(0) + 0.5) / (t.sum() + 1.0)
    anchor = rates(y), rates(1 - y)
    for _ in range(rounds):
        on, off = (((votes * t[:, None]).sum(0) + prior * a) / (t.sum() + prior) for t, a in zip((y, 1 - y), anchor))
        rest = votes - y[:, None] * on - (1 - y)[:, None] * off
        scale = np.sqrt((rest**2).mean(0)) + 1e-9
        shared = rest.T @ rest / len(rest) / np.outer(scale, scale)  # voters that exclude each other repeat nothing
        weight = 1 / np.maximum(1.0, np.where(shared > 0.5, shared, 0).sum(1))
        share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        y = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + (votes * np.log(on / off)) @ weight, -30, 30)))
    return y


def choose(hits: list[np.ndarray], y: np.ndarray, size: int, least: int, times: int = 4, cost: float = 1.5) -> list[int]:
    """Entries, one by one, that cover most toxic rows not yet covered `times` times, a row of the other kind costing
    `cost`; none that gains less than `least`."""
    rows: list[list[int]] = [[] for _ in range(size)]
    for i, found in enumerate(hits):
        for k in found:
            rows[k].append(i)
    of = [np.array(r, np.int64) for r in rows]
    need = np.where(y == 1, times, 0)
    lost = np.array([cost * (y[r] == 0).sum() for r in of], float)
    gain = np.array([np.minimum(need[r], 1).sum() for r in of], float) - lost
    chosen: list[int] = []
    while len(gain):
        best = int(np.argmax(gain))
        now = np.minimum(need[of[best]], 1).sum() - lost[best]
        if now < gain[best]:  # gains only fall: look again
            gain[best] = now
        elif now < least:
            break
        else:
            chosen.append(best)
            need[of[best]] = np.maximum(need[of[best]] - 1, 0)
            gain[best] = -np.inf
    return chosen


def _linear(hits: list[np.ndarray], y: np.ndarray, size: int, rounds: int = 1500, l2: float = 2e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; rows are lists of active features."""
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    at = np.concatenate(hits).astype(np.int64) if len(row) else np.zeros(0, np.int64)
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[at], len(hits)) + b, -30, 30)))
        e = (p - y) / len(hits)
        g = np.r_[np.bincount(at, e[row], size) + l2 * w, e.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_lexicon: int = MAX_LEXICON) -> Model:
    """Learn from at most `max_labelled` labelled documents (by hash of doc_id); labels other than 0 and 1 are ignored.

    The `max_lexicon` entries that speak most clearly become voters. Of copies of a text the smallest doc_id's label counts.

    Without toxic or without other rows every document scores the same: the share of toxic rows, or 0.
    """
    chosen = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))  # two numbers a row
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").where("text IS NOT NULL")
    # copies of a text would pass their own words off as a lexicon: the row of the smallest doc_id stands for them
    rows = rows.groupBy("text").agg(F.min(F.struct("doc_id", "y")).alias("r")).select("text", "r.*")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "y")).alias("r")).select("doc_id", "r.*")
    rows = settled(rows, "labelled").repartition("doc_id")

    def found(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(tokens(t.as_py())) for t in texts], pa.list_(pa.string()))

    each = rows.select("y", F.explode(F.arrow_udf(found, "array<string>")("text")).alias("token"))
    n, toxic = rows.agg(F.count("*"), F.sum("y")).first()
    if not n or not toxic or toxic == n:
        share = (toxic or 0) / n if n else 0.0
        return Model({}, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    least = int(np.clip(toxic / 150, 3, 8))
    counts = each.groupBy("token").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).where(F.col("t") >= least)
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (n - toxic + 1))
    entries = counts.withColumn("odds", odds).where("odds > 2.5").orderBy((F.col("odds") * F.sqrt("t")).desc(), "token")
    lexicon = [r.token for r in entries.limit(max_lexicon).select("token").collect()]
    place = {t: i for i, t in enumerate(lexicon)}

    def hits(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(place[k] for k in tokens(t.as_py()) if k in place) for t in texts], pa.list_(pa.int32()))

    sample = rows.select("doc_id", "y", F.arrow_udf(hits, "array<int>")("text").alias("hits")).orderBy("doc_id").collect()
    y = np.array([r.y for r in sample])
    active = [np.array(r.hits, np.int64) for r in sample]
    kept = choose(active, y, len(lexicon), least)
    slot = np.full(len(lexicon), -1)
    slot[kept] = np.arange(len(kept))
    active = [slot[h][slot[h] >= 0] for h in active]
    votes = np.zeros((len(sample), len(kept)))
    for k, h in enumerate(active):
        votes[k, h] = 1
    w, b = _linear(active, label_model(votes, y), len(kept))
    return Model({lexicon[i]: float(x) for i, x in zip(kept, w) if x}, b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with a column `toxicity` (a free name), 0 to 1, higher meaning likelier toxic.

    NULL, empty and wordless texts score what a document without any lexicon entry scores.
    """

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return docs.withColumn(free_name(docs, "toxicity"), F.arrow_udf(run, "double")(F.col("text")))
