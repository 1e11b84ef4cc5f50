import random
import re

from pyspark.sql import functions as F

from pulsekit.llm import licenses
from tests.llm.conftest import ODD, sentence


def test_planted_notices(spark, words):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(120):
        lines = [sentence(rng, words, rng.randrange(3, 40)) for _ in range(6)]
        names = rng.sample(sorted(licenses.TEMPLATES), rng.randrange(3))
        for name in names:
            notice = licenses.TEMPLATES[name]
            lines.insert(rng.randrange(len(lines)), rng.choice([notice, notice.upper(), f"note: {notice} {sentence(rng, words, 5)}"]))
        rows.append((i, "\n".join(lines)))
        want[i] = sorted(names)
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: sorted(n.license for n in r.licenses) for r in got} == want
    for r in got:
        for n in r.licenses:
            assert r.text[n.start : n.end] == n.text and r.text[: n.start].count("\n") == n.line and n.saved > 0


def test_versions_and_wording_decide():
    scan = licenses.Scanner(licenses.TEMPLATES, licenses.TOLERANCE_PERCENT).scan
    only = lambda text: [n["license"] for n in scan(text)]
    assert only("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert only("This work is licensed under the GNU General Public License, version 4.") == []
    assert only("Licensed under CC BY-SA 4.0. Released under the MIT License.") == ["CC-BY-SA-4.0", "MIT"]
    assert only("he lost his driving license under the bridge") == []
    text = licenses.TEMPLATES["MIT-text"].replace("free of charge", "free of any charge")
    found = scan(text)
    assert [n["license"] for n in found] == ["MIT-text"] and found[0]["inserted"] == ["any"] and found[0]["missing"] == []


def test_odd_rows(odd, none):
    got = licenses.scan(odd)
    assert got.columns == [*odd.columns, "licenses_"] and got.count() == len(ODD)
    assert got.where(F.size("licenses_") > 0).count() == 0
    assert licenses.scan(none).count() == 0
    assert licenses.scan(odd, {}).where(F.size("licenses_") > 0).count() == 0
    assert re.search(licenses.ANCHORS, "LICENCE", re.IGNORECASE)


def names(text):
    found = licenses.Scanner(licenses.TEMPLATES, licenses.TOLERANCE_PERCENT).scan(text)
    assert all(text[n["start"] : n["end"]] == n["text"] and text[: n["start"]].count("\n") == n["line"] for n in found)
    return [n["license"] for n in found]


def test_short_notices_and_slots():
    assert names("some words\nAll rights reserved.\nmore") == ["all-rights-reserved"]
    assert names("Copyright 2024 Jane Doe. All rights reserved.") == ["proprietary"]
    assert names("Copyright (c) 1999-2024 The Example Company, Inc. All Rights Reserved") == ["proprietary"]
    assert names("Released under the terms MIT License.") == ["MIT"] and names("Released under MIT License") == ["MIT"]
    assert names("Released under the License.") == [] and names("Licensed under CC BY-SA 3.0.") == []
    assert names("copyright law is old and all right, they reserved seats") == []


def test_wrapped_notices_and_copies():
    for name, text in licenses.TEMPLATES.items():
        for mark in ("\n", "\n# ", "\r\n * ", "\n// "):
            for width in (2, 5, 11):
                parts = text.split()
                wrapped = mark.join(" ".join(parts[i : i + width]) for i in range(0, len(parts), width))
                assert names(f"first line{mark}{wrapped}{mark}last line") == [name]
        assert names(" ".join([text] * 3)) == [name] * 3
        assert names(f"{text} and\nagain {text}") == [name] * 2


def test_planted_table_against_a_plain_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = licenses.scan(docs).select(F.explode("licenses").alias("n")).groupBy("n.license").count().collect()
    plain = {
        "all-rights-reserved": r"(?i)\ball rights reserved", "MIT": r"(?i)released under the mit license",
        "Apache-2.0": r"(?i)licensed under the apache license, version 2\.0", "CC-BY-NC-4.0": r"(?i)licensed under cc by-nc 4\.0",
        "GPL-3.0": r"(?i)licensed under the gnu general public license, version 3",
    }
    want = {k: docs.select(F.sum(F.regexp_count("text", F.lit(v)))).first()[0] for k, v in plain.items()}
    assert {r.license: r["count"] for r in got} == {k: n for k, n in want.items() if n} and want["all-rights-reserved"] > 0
