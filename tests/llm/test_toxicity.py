import random

import numpy as np

from pulsekit.llm import toxicity
from pulsekit.llm.common import fold
from tests.llm.conftest import ODD, sentence


def test_held_out_documents(spark, words):
    rng = random.Random(7)
    insults = ["zzgrob", "zzfies", "qwmies"] + [f"vxlow{e}" for e in ("a", "b", "cd", "ef", "gh")]
    rows = []
    for i in range(900):
        text, toxic = sentence(rng, words, rng.randrange(20, 150)).split(), int(i % 6 == 0)
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(insults))
        rows.append((i, " ".join(text), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.where(fold("doc_id", 5) != 0).select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    got = toxicity.score(docs, model).where(fold("doc_id", 5) == 0).collect()
    assert len(got) > 120 and sum((r.toxicity >= 0.5) != bool(r.toxic) for r in got) <= 2


def test_label_model_mends_labels_and_discounts_repeats():
    rng = np.random.default_rng(3)
    truth = rng.random(2000) < 0.2
    votes = np.array([(rng.random(2000) < np.where(truth, 0.7, 0.01)) for _ in range(4)], float).T
    labels = truth ^ (rng.random(2000) < 0.03)
    y = toxicity.label_model(votes, labels)
    assert ((y > 0.5) == truth).mean() > 0.95
    alone = toxicity.label_model(votes[:, :1], truth)
    repeated = toxicity.label_model(np.repeat(votes[:, :1], 6, axis=1), truth)
    assert np.abs(alone - repeated).max() < 0.05


def test_choose_covers_and_skips_costly_entries():
    y = np.array([1, 1, 1, 0, 0])
    hits = [np.array([0, 2]), np.array([0, 2]), np.array([1, 2]), np.array([2]), np.array([2])]
    assert toxicity.choose(hits, y, 3, 1, times=1) == [0, 1]
    assert toxicity.choose([], np.array([]), 0, 1) == []


def test_odd_rows(spark, odd, none, no_labels):
    model = toxicity.fit(none, no_labels)
    got = toxicity.score(odd, model)
    assert got.columns == [*odd.columns, "toxicity_"] and got.count() == len(ODD)
    assert all(0 <= r.toxicity_ < 0.5 for r in got.collect())
    marks = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (None, 1), (7, None), (6, 9)], "doc_id long, toxic int")
    model = toxicity.fit(odd, marks)
    assert all(0 <= r.toxicity_ <= 1 for r in toxicity.score(odd, model).collect())
    assert toxicity.score(none, model).count() == 0
