import random

from pulsekit.llm import langid
from pulsekit.llm.common import fold
from tests.llm.conftest import ODD

SYLLABLES = {"en": ["th", "ing", "er", "and", "wh"], "de": ["sch", "ung", "ei", "ß", "ver"], "fr": ["eau", "oi", "é", "que", "ment"]}


def made(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60)))
        out.append((i, text, lang))
    return out


def test_held_out_documents(spark):
    docs = spark.createDataFrame(made(600), "doc_id long, text string, lang string")
    model = langid.fit(docs.where(fold("doc_id", 4) != 2))
    assert model.langs == ["de", "en", "fr"] and 0 < (model.weights != 0).mean() < 0.5
    got = langid.identify(docs.where(fold("doc_id", 4) == 2), model).select("lang", "language.*").collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    again = langid.fit(docs.repartition(5).where(fold("doc_id", 4) != 2))
    assert again.temperature == model.temperature and (again.weights == model.weights).all()


def test_ngrams():
    at, counts = langid.ngrams("Ab, ab!")
    assert counts.sum() == len(" ab ab ") + len(" ab ab ") - 1 + len(" ab ab ") - 2
    same = langid.ngrams("  ab--AB  ")
    assert (same[0] == at).all() and (same[1] == counts).all()
    assert langid.ngrams(None) is None and langid.ngrams("12 !\n") is None and langid.ngrams("") is None
    assert langid.ngrams("𝒳") is not None


def test_odd_rows(spark, odd, none):
    model = langid.fit(none)
    assert {r.lang_pred for r in langid.identify(odd, model).select("language_.lang_pred").collect()} == {"und"}
    docs = spark.createDataFrame(made(200), "doc_id long, text string, lang string")
    model = langid.fit(docs.unionByName(odd.select("doc_id", "text", "lang")))
    got = langid.identify(odd, model)
    assert got.columns == [*odd.columns, "language_"] and got.count() == len(ODD)
    for r in got.select("doc_id", "language_.*").collect():
        assert (r.lang_pred == "und" and r.score == 0) == (r.doc_id in (1, 2, 3, 6))
    assert langid.accepted(odd, model).columns == odd.columns
    assert langid.accepted(none, model).count() == 0
    one = langid.fit(docs.where("lang = 'fr'"))
    assert langid.identify(docs.limit(1), one).first().language == ("fr", 1.0)


def test_every_language_is_learned_and_copies_count_once(spark):
    rows = made(3000, 7)
    rng = random.Random(8)
    rare = [" ".join("".join(rng.choice(["zq", "ox", "yk", "uu"]) for _ in range(3)) for _ in range(30)) for _ in range(40)]
    rows += [(9000 + i, t, "zz") for i, t in enumerate(rare)] + [(10_000 + i, rows[0][1], rows[0][2]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, drawn = langid.sample(docs.select("text", "lang"), 60, 10)
    got = drawn.collect()
    assert langs == ["de", "en", "fr", "zz"] and {r.lang for r in got if not r.held} == set(langs)
    assert len(got) <= 60 + 11 * len(langs) and len({(r.lang, r.text) for r in got}) == len(got)
    assert sum(r.lang == "zz" for r in got) == 10
    model = langid.fit(docs, 60)
    assert model.langs == langs
    found = langid.identify(docs.where("lang = 'zz'"), model).select("language.lang_pred").collect()
    assert [r.lang_pred for r in found] == ["zz"] * 40
