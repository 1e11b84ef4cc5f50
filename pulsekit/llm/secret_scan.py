"""Secrets in texts: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

Two models of the next character given the one before it are counted from labelled tokens, one from random strings (keys,
hashes, passwords), one from ordinary identifiers and words. A long token is a secret if the log-likelihood ratio of the
two models, together with how often either kind occurs among the labelled tokens, speaks clearly for the random one.
Nobody labels all secrets, so ordinary tokens that the first models take for random strings are left out of the final ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import free_name, settled

# Kinds of spans in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "markov")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
# A run shorter than the least length can hold no longer one, so these two need no look at failing matches.
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]{14,}"), re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGNED = 12

# Characters of tokens; 0 stands for the beginning of a token, the last code for any other character.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_TOKEN = "[A-Za-z0-9+/_=-]"
_CODES = len(ALPHABET) + 2
_CODE = np.full(256, _CODES - 1, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, len(ALPHABET) + 1)
# Least length of tokens that are judged, and of ordinary ones that are learned from.
MIN_TOKEN, MIN_LEARNED = 16, 12
# A token is a secret if the odds for it are exp(MARGIN) or better.
MARGIN = 3.0
# The share of all characters that a context must hold to count as much as the characters' plain frequencies.
_RARE = 0.03

SPANS = "array<struct<kind: string, start: int, stop: int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) in code points by the fixed patterns: leftmost, not overlapping within a kind."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def _free_tokens(text: str, spans: list[tuple[str, int, int]], pattern: re.Pattern) -> list[tuple[int, int]]:
    """Where tokens lie that touch none of the spans; one pass over both."""
    taken, free, at = sorted((a, b) for _, a, b in spans), [], 0
    reach = list(accumulate((b for _, b in taken), max))  # up to where the spans so far cover the text
    for m in pattern.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            at += 1
        if not at or reach[at - 1] <= m.start():
            free.append(m.span())
    return free


def labelled_tokens(docs: DataFrame, min_length: int = MIN_LEARNED) -> DataFrame:
    """Distinct rows (token, secret) of `docs` (text): what the fixed patterns find, without its name and marks, is labelled
    a secret; other tokens of `min_length` characters or more are ordinary."""
    pattern = re.compile(_TOKEN + "{%d,}" % min_length)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, bool], None] = {}
            for text in batch.column(0).to_pylist():
                text = text or ""
                spans = base_spans(text)
                for kind, a, b in spans:
                    value = _ASSIGN.match(text, a)[2] if kind == "assign" else text[a:b]
                    found[value, True] = None
                for a, b in _free_tokens(text, spans, pattern):
                    found[text[a:b], False] = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in found], pa.string()), pa.array([s for _, s in found], pa.bool_())], ["token", "secret"]
            )

    return docs.select("text").mapInArrow(tokens, "token string, secret boolean").distinct()


def _cells(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers (character before, this one) of all characters, and where each token begins among them."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    starts = np.cumsum(sizes) - sizes
    here = _CODE[np.frombuffer(b"".join(tokens), np.uint8)]
    last = np.r_[0, here[:-1]]
    last[starts] = 0
    return last * _CODES + here, starts


def _ratios(ratio: np.ndarray, tokens: list[bytes]) -> np.ndarray:
    if not tokens:
        return np.zeros(0)
    cells, starts = _cells(tokens)
    return np.add.reduceat(ratio[cells].astype(np.float64), starts)


@dataclass
class Model:
    """Log-likelihood ratio per cell, random over ordinary, and the log odds of a secret before a token is looked at."""

    ratio: np.ndarray
    prior: float

    def scores(self, tokens: list[bytes]) -> np.ndarray:
        """Log odds of non-empty tokens to be random strings."""
        return _ratios(self.ratio, tokens) + self.prior


def _log_likelihood(counts: np.ndarray) -> np.ndarray:
    """Log probability of a character after another. A rare context leans on how often characters occur at all, whatever
    the size of the sample, and these on equal chances."""
    counts = counts.reshape(_CODES, _CODES).astype(float)
    plain = (counts.sum(axis=0) + 1) / (counts.sum() + _CODES)
    lent = max(1.0, _RARE * counts.sum())
    return np.log((counts + lent * plain) / (counts.sum(axis=1, keepdims=True) + lent)).ravel()


def _fit(samples: DataFrame) -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, tokens = np.zeros((2, _CODES**2), np.int64), [0, 0]
        for batch in batches:
            secret = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            text = np.array(batch.column(0).to_pylist(), object)
            for kind in (0, 1):
                mine = [t.encode("latin-1", "replace") for t in text[secret == bool(kind)]]
                if mine:
                    counts[kind] += np.bincount(_cells(mine)[0], minlength=_CODES**2)
                    tokens[kind] += len(mine)
        kind, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[kind, 0, 1]), pa.array(np.r_[cell, -1, -1]), pa.array(np.r_[counts[kind, cell], tokens])], ["kind", "cell", "n"]
        )

    cells = samples.mapInArrow(count, "kind long, cell long, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, _CODES**2))
    held = cells[cells.cell >= 0]
    counts[held.kind, held.cell] = held.n
    tokens = [int(cells[(cells.cell < 0) & (cells.kind == k)].n.sum()) for k in (0, 1)]
    ratio = _log_likelihood(counts[1]) - _log_likelihood(counts[0])
    return Model(ratio.astype(np.float32), float(np.log((tokens[1] + 1) / (tokens[0] + 1))))


def fit(samples: DataFrame) -> Model:
    """The two models from all of `samples` (token, secret); NULL and empty tokens and NULL labels are ignored.

    Tasks count cells, of which there are 2 * 69^2 at most however many tokens there are; only these reach the driver.
    The second round leaves out the ordinary tokens whose odds to be random are even or better in the first.
    """
    known = settled(samples.where("secret IS NOT NULL AND token <> ''").select("token", "secret"), "tokens")
    first = _fit(known)
    ratio, prior = first.ratio, first.prior

    @F.arrow_udf("double")
    def odds(tokens: pa.Array) -> pa.Array:
        return pa.array(_ratios(ratio, [t.encode("latin-1", "replace") for t in tokens.to_pylist()]) + prior)

    return _fit(known.where(F.col("secret") | (odds("token") < 0)))


def scan(docs: DataFrame, model: Model, min_length: int = MIN_TOKEN, margin: float = MARGIN) -> DataFrame:
    """`docs` with a column `secrets` (a free name): spans (kind, start, stop) in code points by start, then kind.

    Fixed patterns come first and stay; a token of `min_length` or more characters that touches none of them is a span of
    kind `markov` if its log odds reach `margin`. Whole texts are read; a NULL or empty text has no spans, repeated rows are
    scanned each, and spans of several kinds may overlap.
    """
    pattern = re.compile(_TOKEN + "{%d,}" % min_length)
    held = docs.sparkSession.sparkContext.broadcast(model.ratio)  # a fixed size: one number per cell
    prior, order = model.prior, {kind: i for i, kind in enumerate(KINDS)}

    @F.arrow_udf(SPANS)
    def spans_of(texts: pa.Array) -> pa.Array:
        found, asked, tokens = [], [], []
        for i, text in enumerate(texts):
            text = text.as_py() or ""
            spans = base_spans(text)
            found.append(spans)
            for a, b in _free_tokens(text, list(spans), pattern):
                asked.append((i, a, b))
                tokens.append(text[a:b].encode())
        for (i, a, b), odds in zip(asked, _ratios(held.value, tokens).tolist()):
            if odds + prior >= margin:
                found[i].append(("markov", a, b))
        rows = [[dict(kind=k, start=a, stop=b) for k, a, b in sorted(s, key=lambda x: (x[1], order[x[0]]))] for s in found]
        return pa.array(rows, _SPANS)

    return docs.withColumn(free_name(docs, "secrets"), spans_of("text"))


def listed(spans, kinds: tuple[str, ...] = KINDS):
    """Spans of some kinds as text: kind:start:stop, joined by commas."""
    mine = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(mine, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
