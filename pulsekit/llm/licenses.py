"""License notices found by conditional compression.

A block is the words around a word that notices use, across line breaks and the marks of comments, behind the last notice
found. Templates are laid on it word by word, that word of the block on the same word of the template, so every copy of a
notice is compared with its own words. The block is compressed by itself and with each template within its tolerance of
missing and inserted words as a raw zstandard dictionary; the template that saves most bytes is the answer.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import free_name

# Notices in common use, by SPDX name. "..." is a slot: up to SLOT_WORDS words, as a year and a holder.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
    "proprietary": "Copyright ... All rights reserved.",
}
# A notice of any template holds one of these.
ANCHORS = r"licen[sc]|permission|permitted|copyright|public\W+domain|rights\W+reserved"
# Words of a template, of a hundred, that may be missing or inserted; the digits of a version never.
TOLERANCE_PERCENT = 10
# Below ten words: templates of this many words may differ in one, but not lose a word that no other template has.
SHORT_WORDS = 5
SLOT_WORDS = 16

SCHEMA = (
    "array<struct<license: string, start: int, end: int, line: int, saved: int, size: int, "
    "missing: array<string>, inserted: array<string>, text: string>>"
)
_WORD = re.compile(r"[^\W_](?:[\w.\-]*[^\W_])?")


@dataclass
class _Template:
    name: str
    words: list[str]
    slots: set[int]  # numbers of words before a slot
    dictionary: bytes


def _templates(texts: Mapping[str, str]) -> list[_Template]:
    made = []
    for name, text in texts.items():
        words, slots = [], set()
        for part in text.split("..."):
            slots.add(len(words))
            words += [w.lower() for w in _WORD.findall(part)]
        made.append(_Template(name, words, slots - {0, len(words)}, text.lower().encode()))
    return made


def _lay(template: list[str], block: list[str], slots: set[int], most: int) -> tuple[int, list[str], list[str]] | None:
    """The words of `block` that `template` takes from its start, and the words missing and inserted, in order; the fewest
    of them, then the shortest stretch; None if above `most`. `slots`: template words before a slot."""
    far = most + 1
    # best[j]: (wrong words, words in the slot, way there) with j words of the block taken
    best: list = [(0, 0, None)] + [(far, 0, None)] * len(block)
    for i in range(len(template) + 1):
        if i:
            last, best = best, []
            for j in range(len(block) + 1):
                step = (last[j][0] + 1, 0, (last[j][2], template[i - 1], True))
                if j and block[j - 1] == template[i - 1] and last[j - 1][0] < step[0]:
                    step = (last[j - 1][0], 0, last[j - 1][2])
                best.append(step)
        if i == len(template):
            break
        for j in range(1, len(block) + 1):
            wrong, filled, way = best[j - 1]
            if i in slots and filled < SLOT_WORDS:
                step = (wrong, filled + 1, way)
            else:
                step = (wrong + 1, filled, (way, block[j - 1], False))
            if step[0] < best[j][0]:
                best[j] = step
        if min(b[0] for b in best) > most:
            return None
    end = min(range(len(best)), key=lambda j: best[j][0])
    if best[end][0] > most:
        return None
    missing, inserted, way = [], [], best[end][2]
    while way:
        (missing if way[2] else inserted).append(way[1])
        way = way[0]
    return end, missing[::-1], inserted[::-1]


class Scanner:
    """Finds notices in one text; compressors are made once."""

    def __init__(self, texts: Mapping[str, str], tolerance: int):
        import zstandard

        self.templates, self.tolerance = _templates(texts), tolerance
        self.anchor = re.compile(ANCHORS, re.IGNORECASE)
        self.plain = zstandard.ZstdCompressor(level=3)
        self.given = []
        for t in self.templates:
            raw = zstandard.ZstdCompressionDict(t.dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given.append(zstandard.ZstdCompressor(level=3, dict_data=raw))
        self.most = [tolerance * len(t.words) // 100 for t in self.templates]
        if tolerance:
            self.most = [max(m, int(len(t.words) >= SHORT_WORDS)) for m, t in zip(self.most, self.templates)]
        self.reach = max((len(t.words) + m + SLOT_WORDS * len(t.slots) for m, t in zip(self.most, self.templates)), default=0)

    def _fit(self, k: int, block: list[str], here: int) -> tuple[int, int, list[str], list[str]] | None:
        """The stretch of `block` around word `here` that template `k` fits (first word and end), words missing and inserted."""
        t, best = self.templates[k], None
        if len(set(t.words) - set(block)) > self.most[k]:
            return None
        for at in (i for i, w in enumerate(t.words) if w == block[here]):
            before = _lay(t.words[:at][::-1], block[:here][::-1], {at - s for s in t.slots}, self.most[k])
            behind = _lay(t.words[at + 1 :], block[here + 1 :], {s - at - 1 for s in t.slots}, self.most[k])
            if before is None or behind is None:
                continue
            missing, inserted = before[1][::-1] + behind[1], before[2][::-1] + behind[2]
            wrong = missing + inserted
            if len(wrong) > self.most[k] or any(w[:1].isdigit() for w in wrong):
                continue
            if len(wrong) * 100 > self.tolerance * len(t.words) and any(self._own(w) for w in missing):
                continue
            if best is None or len(wrong) < len(best[2] + best[3]):
                best = (here - before[0], here + 1 + behind[0], missing, inserted)
        return best

    def _own(self, word: str) -> bool:
        return sum(word in t.words for t in self.templates) == 1

    def _block(self, text: str, words: list[re.Match], at: int, low: int) -> dict | None:
        """The notice around word `at`, not before word `low`; `last` is the number of the word behind it."""
        from_ = max(low, at - self.reach)
        near = words[from_ : at + self.reach + 1]
        block = [w.group().lower() for w in near]
        fits = {k: f for k in range(len(self.templates)) if (f := self._fit(k, block, at - from_))}
        if not fits:
            return None
        raw = text[near[0].start() : near[-1].end()].lower().encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        saved = {k: alone - len(self.given[k].compress(raw)) for k in fits}
        k = min(fits, key=lambda k: (-saved[k], self.templates[k].name))
        first, last, missing, inserted = fits[k]
        start, end = near[first].start(), near[last - 1].end()
        return {
            "license": self.templates[k].name, "start": start, "end": end, "saved": saved[k], "size": alone,
            "missing": missing, "inserted": inserted, "text": text[start:end], "last": from_ + last,
        }

    def scan(self, text: str | None) -> list[dict]:
        found: list[dict] = []
        if not text or not self.templates or not self.anchor.search(text):
            return found
        words = list(_WORD.finditer(text))
        starts = [w.start() for w in words]
        low = line = counted = 0
        for a in self.anchor.finditer(text):
            at = bisect_right(starts, a.start()) - 1
            if at < low or words[at].end() <= a.start():
                continue
            notice = self._block(text, words, at, low)
            if notice:
                low = notice.pop("last")
                line, counted = line + text.count("\n", counted, notice["start"]), notice["start"]
                found.append(notice | {"line": line})
        return found


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, tolerance: int = TOLERANCE_PERCENT) -> DataFrame:
    """`docs` with a column `licenses` (a free name): an array of the notices found, in order of their place.

    A notice has the template's name, its span in code points of the text, the number of its line, the bytes saved by
    the template and the size without it, the words missing and inserted, and the words as they stand. NULL, empty and
    noticeless texts give an empty array.
    """
    texts = dict(TEMPLATES if templates is None else templates)

    def run(values: pa.Array) -> pa.Array:
        scanner = Scanner(texts, tolerance)
        return pa.array([scanner.scan(t.as_py()) for t in values], _ARROW)

    return docs.withColumn(free_name(docs, "licenses"), F.arrow_udf(run, SCHEMA)(F.col("text")))


_ARROW = pa.list_(
    pa.struct(
        [
            ("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("line", pa.int32()), ("saved", pa.int32()),
            ("size", pa.int32()), ("missing", pa.list_(pa.string())), ("inserted", pa.list_(pa.string())), ("text", pa.string()),
        ]
    )
)
