"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Languages are those of all documents. Trained with follow-the-regularised-leader and an elastic net: the shards of a
bounded sample of distinct texts, some of every language, are each passed by one task, and the driver averages their states between rounds (a state is of fixed size). A temperature, fitted on sampled
documents left out of training, calibrates the probabilities. Document frequencies cover every document learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import free_name, settled

HASH_BITS = 15
LONGEST = 3
# Distinct texts in the sample the weights are trained on, dealt to the languages by their shares, and the texts that any
# language gives, if it has as many: at most MAX_TRAINING + (LEAST_TRAINING + 1) * languages in all.
MAX_TRAINING = 6000
LEAST_TRAINING = 100
SHARDS = 4
ROUNDS = 2
# Follow-the-regularised-leader: learning rate and its damping, L1 and L2 of the elastic net.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.001
UNDETERMINED = "und"
# Below this calibrated probability a corpus filter lets a document go.
MIN_SCORE = 0.35

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000))
    return _letters[0]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed n-grams of the letters of a text and their counts; None if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letter_table()[np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes > 0xFFFF)
    if len(beyond):
        letter[beyond] = [chr(c).isalpha() for c in codes[beyond]]
    if not letter.any():
        return None
    # runs of anything but letters become one space, and the text stands between spaces
    codes = np.where(letter, codes, 32)
    keep = letter | np.r_[True, letter[:-1]]
    codes = codes[keep].astype(np.uint32)
    codes = np.r_[np.uint32(32) if codes[0] != 32 else codes[:0], codes, np.uint32(32) if codes[-1] != 32 else codes[:0]]
    hashed, running = [], np.zeros(len(codes), np.uint32)
    for n in range(LONGEST):
        if n >= len(codes):
            break
        running = running[: len(codes) - n] * np.uint32(0x01000193) + codes[n:] + np.uint32(n + 1)
        hashed.append((running * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS))
    counts = np.bincount(np.concatenate(hashed), minlength=1 << HASH_BITS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    temperature: float = 1.0

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Positions and values of the unit TF-IDF vector, with a constant in the last place."""
        found = ngrams(text)
        if found is None:
            return None
        at, counts = found
        value = (1 + np.log(counts)) * self.idf[at]
        return np.r_[at, 1 << HASH_BITS], np.r_[value / max(np.sqrt(value @ value), 1e-12), 1.0]

    def predict(self, text: str | None) -> tuple[str, float]:
        found = self.vector(text)
        if found is None or not self.langs:
            return UNDETERMINED, 0.0
        at, value = found
        p = _softmax(value @ self.weights[at] / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(1 << HASH_BITS, np.int64)
    docs = 0
    for batch in batches:
        for text in batch.column(0):
            found = ngrams(text.as_py())
            if found is not None:
                df[found[0]] += 1
                docs += 1
    at = np.flatnonzero(df)
    ngram, count = np.r_[at, -1], np.r_[df[at], docs]
    yield pa.RecordBatch.from_arrays([pa.array(ngram, pa.int32()), pa.array(count, pa.int64())], ["ngram", "df"])


_VECTORS = "at array<int>, value array<double>, y int, h long, held boolean"


def _vectors(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    place = {lang: i for i, lang in enumerate(model.langs)}
    for batch in batches:
        columns = (c.to_pylist() for c in batch.columns)
        rows = [(model.vector(t), place[lang], h, held) for t, lang, h, held in zip(*columns)]
        rows = [r for r in rows if r[0] is not None]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([v[0] for v, *_ in rows], pa.list_(pa.int32())),
                pa.array([v[1] for v, *_ in rows], pa.list_(pa.float64())),
                pa.array([y for _, y, *_ in rows], pa.int32()),
                pa.array([h for *_, h, _ in rows], pa.int64()),
                pa.array([held for *_, held in rows], pa.bool_()),
            ],
            ["at", "value", "y", "h", "held"],
        )


def _pass(shard: pa.Table, z: np.ndarray, n: np.ndarray) -> pa.Table:
    """One shard, once, in the order of its hashes; the state it ends with."""
    z, n = z.copy(), n.copy()
    shard = shard.sort_by([("h", "ascending"), ("y", "ascending")])
    for at, value, y in zip(*(shard.column(c) for c in ("at", "value", "y"))):
        i, x = at.values.to_numpy(), value.values.to_numpy()
        w = _weights(z[i], n[i])
        slope = _softmax(x @ w)
        slope[y.as_py()] -= 1
        g = x[:, None] * slope
        squared = n[i] + g * g
        z[i] += g - (np.sqrt(squared) - np.sqrt(n[i])) / ALPHA * w
        n[i] = squared
    return pa.table({"z": pa.array([z.tobytes()], pa.binary()), "n": pa.array([n.tobytes()], pa.binary()), "seen": [shard.num_rows]})


def _state(rows: DataFrame, z: np.ndarray, n: np.ndarray) -> list:
    return rows.groupBy("shard").applyInArrow(lambda t: _pass(t, z, n), "z binary, n binary, seen long").collect()


def sample(docs: DataFrame, max_training: int = MAX_TRAINING, least: int = LEAST_TRAINING) -> tuple[list[str], DataFrame]:
    """All languages of `docs` (text, lang) with a letter in some text, and training rows (text, lang, h, held) of each.

    Texts are distinct within a language and taken in the order of their hashes: a language gives its share of
    `max_training`, rounded up, but no fewer than `least` while it has them, and never more. Every tenth is held out.
    """
    lettered = docs.where(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    keys = settled(lettered.select("lang", "h").distinct(), "langid-texts")
    counts = {r.lang: r["count"] for r in keys.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return [], lettered.select("text", "lang", "h", F.lit(False).alias("held"))
    total = sum(counts.values())
    quota = {lang: max(least, -(-max_training * n // total)) for lang, n in counts.items()}
    # hashes below a limit first, more than enough of them: the ranking then sees a bounded number of rows
    limits = [(lang, quota[lang], int(min(1.0, (quota[lang] * 1.5 + 200) / n) * (1 << 31))) for lang, n in counts.items()]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, quota long, below long")
    at = F.pmod("h", F.lit(1 << 31))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(at, "h"))
    # a row per language, as few as the model has columns; without the hint Spark takes a listed table for a large one
    drawn = keys.join(F.broadcast(limits), "lang").where(at < F.col("below")).withColumn("rank", rank).where("rank <= quota")
    drawn = settled(drawn.select("lang", "h", (F.col("rank") % 10 == 0).alias("held")), "langid-drawn")
    rows = lettered.join(drawn, ["lang", "h"]).dropDuplicates(["lang", "h"])
    return sorted(counts), rows.select("text", "lang", "h", "held")


def fit(docs: DataFrame, max_training: int = MAX_TRAINING) -> Model:
    """Learn from the `text` and `lang` of `docs`, rows without either aside. Without rows the model knows no language.

    Languages are those of all rows. Weights come from a `sample` of distinct texts of every language, a tenth of which
    only calibrates the temperature; frequencies come from all.
    """
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    found = docs.select("text").mapInArrow(_frequencies, "ngram int, df long").groupBy("ngram").agg(F.sum("df").alias("df"))
    counts = {r.ngram: r.df for r in found.collect()}  # at most 2 ** HASH_BITS + 1 rows
    total = counts.pop(-1, 0)
    df = np.zeros(1 << HASH_BITS)
    df[list(counts)] = list(counts.values())
    langs, chosen = sample(docs, max_training)
    model = Model(langs, np.log((1 + total) / (1 + df)) + 1)
    if not langs:
        return model
    rows = settled(chosen.mapInArrow(lambda b: _vectors(b, model), _VECTORS), "langid")
    held, rows = rows.where("held"), rows.where("NOT held").withColumn("shard", F.pmod("h", F.lit(SHARDS)))
    shape = ((1 << HASH_BITS) + 1, len(langs))
    z, n = np.zeros(shape), np.zeros(shape)
    for _ in range(ROUNDS):
        # as many rows as shards, whatever the number of partitions
        state = _state(rows, z, n)
        share = np.array([s.seen for s in state], float) / max(1, sum(s.seen for s in state))
        if not state:
            break
        z = sum(w * np.frombuffer(s.z).reshape(shape) for w, s in zip(share, state))
        n = sum(w * np.frombuffer(s.n).reshape(shape) for w, s in zip(share, state))
    model.weights = _weights(z, n)
    logits, truth = [], []
    for r in held.collect():  # a tenth of the sample
        logits.append(np.array(r.value) @ model.weights[np.array(r.at)])
        truth.append(r.y)
    if logits:
        logits, truth = np.array(logits), np.array(truth)
        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
        loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with a struct column `language` (a free name): lang_pred and score, the calibrated probability.

    A NULL text, or one without letters, is `und` with score 0. Ties go to the first language by name.
    """

    def run(texts: pa.Array) -> pa.Array:
        made = [model.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], names=["lang_pred", "score"]
        )

    return docs.withColumn(free_name(docs, "language"), F.arrow_udf(run, "struct<lang_pred: string, score: double>")(F.col("text")))


def accepted(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is determined with at least `min_score`."""
    name = free_name(docs, "language")
    found = identify(docs, model)
    return found.where((F.col(f"{name}.lang_pred") != UNDETERMINED) & (F.col(f"{name}.score") >= min_score)).select(*docs.columns)
