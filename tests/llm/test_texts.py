from __future__ import annotations

import math
import random
import re
import textwrap
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locuspark.llm import language, licenses, quality, secrets
from locuspark.llm.license_texts import LONG, TEMPLATES
from tests.llm.conftest import ODD

WORDS = {"en": ["the", "thing", "whether", "and", "ing"], "fr": ["queue", "eaux", "étre", "les", "où"], "de": ["schütz", "keit", "und", "zwölf", "pfau"]}


def prose(rng, lang, n=60):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_language_held_out_and_rejection(table):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang), lang, "a") for i, lang in enumerate(random.Random(2).choices(list(WORDS), k=240))]
    rows += [(900, "漢字かな交じり文" * 9), *[(i + 1000 if i else i, t) for i, t, *_ in ODD]]
    model = language.fit_held_in(table(rows))
    got = {r.doc_id: r for r in language.predict(table(rows), model).collect()}
    assert all(got[i].lang_pred == lang and not got[i].lang_rejected for i, _, lang, *_ in rows[:240])
    assert got[900].lang_rejected and got[900].lang_pred in WORDS
    assert all(got[k].lang_pred == "und" and got[k].lang_score == 0 and got[k].lang_rejected for k in (1001, 1002, 1003))
    assert len(got[5 + 1000].text) == 150_000 and 0 <= got[1005].lang_score <= 1
    assert language.predict(table([]), model).count() == 0
    nothing = language.fit_held_in(table([]))
    assert {r.lang_pred for r in language.predict(table(ODD), nothing).collect()} == {"und"}


def test_unseen_language_of_the_same_script_and_random_letters_are_rejected(table):
    """Made-up languages of their own syllables; short clean texts stay."""
    rng = random.Random(8)
    syllable = lambda: rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice("nrstl ").strip()
    parts = {k: [syllable() for _ in range(40)] for k in ("aa", "bb", "cc", "dd")}
    vocabulary = {k: ["".join(rng.choices(v, k=rng.randint(1, 3))) for _ in range(400)] for k, v in parts.items()}
    rows = [(i, " ".join(rng.choices(vocabulary[lang], k=rng.choice([8, 30, 120, 400]))), lang, "a") for i, lang in enumerate(rng.choices(["aa", "bb", "cc"], k=600))]
    unseen = [(1000 + i, " ".join(rng.choices(vocabulary["dd"], k=rng.choice([30, 120])))) for i in range(40)]
    junk = [(2000 + i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))) for i, n in enumerate([60, 500] * 10)]
    model = language.fit_held_in(table(rows))
    got = {r.doc_id: r.lang_rejected for r in language.predict(table(rows + unseen + junk), model).collect()}
    clean = [got[r[0]] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert all(got[i] for i, *_ in unseen + junk)
    assert sum(clean) <= 0.02 * len(clean)


def test_ngrams_are_counted_over_whole_texts(monkeypatch):
    text = "Straße 12 über Öl, " * 50
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "PIECE", 7)
    assert (language.ngram_counts(text) == whole).all()


def test_quality_learns_and_scores_everything(table, spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, "en") if i % 2 else " | ".join(["junk"] * rng.randint(5, 40))) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(3, None), (None, 1), (99999, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality(table([*rows, *[((i or 0) + 1000, t) for i, t, *_ in ODD]]), labels).collect()}
    out = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out for i in out) and sum(got[i].predicted == i % 2 for i in out) >= 0.97 * len(out)
    assert len(got) == 407 and all(0 <= r.score <= 1 for r in got.values())
    none = quality.quality(table(ODD), labels.limit(0)).collect()
    assert len(none) == len(ODD) and quality.quality(table([]), labels).count() == 0


def test_forest_walk_matches_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    forest = quality.grow(x, (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float), trees=5, depth=3)
    for row, got in zip(x[:40], forest.score(x)[:40]):
        margin = forest.start
        for t in range(5):
            at = 0
            while at < 7:
                at = 2 * at + 1 + int(row[forest.feature[t, at]] > forest.threshold[t, at])
            margin += forest.leaf[t, at - 7]
        assert got == pytest.approx(1 / (1 + math.exp(-margin)))


def test_secrets_by_hand():
    body = b"A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = "ghp_" + body.decode() + secrets.base62(zlib.crc32(body)).decode()
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    text = f"é PassWord: 'abcdefghijkl' token=short api-key=no AKIA{'B' * 14} {'0a' * 8}z deadbeef {good} {bad} ſecret=abcdefghijklmnop"
    got = secrets.find_spans(text)
    assert [(k, text[a:b]) for k, a, b in got] == [
        ("assign", "PassWord: 'abcdefghijkl"), ("access", "AKIA" + "B" * 14), ("hex", "0a" * 8), ("github", good),
    ]


def test_secrets_hex_runs_at_every_place():
    for lead in range(20):
        for n in (15, 16, 17, 40):
            text = "x" * lead + "a1" * 30
            text = text[: lead + n] + "y"
            assert [(a, b) for _, a, b in secrets.find_spans(text)] == ([(lead, lead + n)] if n >= 16 else [])


def test_secrets_odd_rows(table):
    got = secrets.scan_secrets(table([*ODD, (50, "x" * 200_000 + " secret=" + "q" * 12)])).collect()
    assert len(got) == len(ODD) + 1
    assert [r.spans for r in got if r.doc_id == 50] == ["assign:200001:200020"]
    assert all(r.spans == "" and r.n_assign == 0 for r in got if r.doc_id != 50) and secrets.scan_secrets(table([])).count() == 0


def words_by_hand(text):
    return re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", text.lower())


def license_by_hand(files, templates=TEMPLATES, least=0.7):
    """Every run of every text against every template, with plain dictionaries."""
    split = {x: words_by_hand(x) for lines in templates.values() for x in lines}
    vocabulary = {w for x in split.values() for w in x}
    frequency = Counter(w for _, _, text in files for w in set(words_by_hand(text or "")) & vocabulary)
    weight = {w: math.log((1 + len(files)) / (1 + frequency[w])) + 1 for w in vocabulary}
    rarest = math.log(1 + len(files)) + 1

    def cosine(run, template):
        if not all(k in run for part in re.findall(r"\*([^*]+)\*", template) for k in words_by_hand(part)):
            return 0.0
        there = Counter(split[template])
        here = Counter(w for w in run if w in vocabulary)
        unknown = len(run) - sum(here.values())
        dot = sum(n * there[w] * weight[w] ** 2 for w, n in here.items())
        one = sum((n * weight[w]) ** 2 for w, n in here.items()) + unknown * rarest**2
        two = sum((n * weight[w]) ** 2 for w, n in there.items())
        return round(dot / math.sqrt(one * two), 9)

    own = {}
    for i, path, text in files:
        words, hits = words_by_hand(text or ""), []
        for name, lines in templates.items():
            for x in lines:
                size = len(split[x])
                runs = [(max(0, end - size), end) for end in range(1, len(words) + 1)]
                if words and re.match(r"(?i)(licen[cs]e|copying|notice)([.-].*)?$", (path or "").split("/")[-1]):
                    runs.append((0, len(words)))
                for start, end in runs:
                    c = cosine(words[start:end], x)
                    if c >= least:
                        hits.append((-c, next(k for k in range(start, end) if words[k] in split[x]), name))
        own[i] = min(hits) if hits else None
    given = {}
    for i, path, _ in files:
        if path and re.match(r"(?i)(licen[cs]e|copying|notice)([.-].*)?$", path.split("/")[-1]) and own[i]:
            folder = path.rpartition("/")[0]
            given[folder] = min(given.get(folder, (0, "", "")), (own[i][0], path, own[i][2]))
    out = {}
    for i, path, _ in files:
        up = path.rpartition("/")[0] if path else None
        while up is not None and up not in given and up:
            up = up.rpartition("/")[0]
        if own[i]:
            out[i] = (own[i][2], -own[i][0], own[i][2], None)
        else:
            out[i] = (None, None, given[up][2] if up in given else None, up if up in given else None)
    return out


MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
GPL_NOTICE = """#!/bin/sh
# frobnicate: a tool for things
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version {} of the License, or
# (at your option) any later version.
echo hello
"""
LICENSED = [
    (1, "r/LICENSE", "foo\nReleased under the MIT License.\nbar"), (2, "r/a/b.txt", "nothing"), (3, "r/a/c/LICENSE", "Licensed under the Apache License, Version 2.0."),
    (4, "r/a/c/d/e.txt", "text the license of"), (5, "s/x.txt", None), (6, None, "This work is licensed under the GNU General Public License, version 3."),
    (7, "r/z.txt", "İ licensed\nLicensed under CC BY-NC 4.0."), (8, "top.txt", "work is under the"), (9, "r/a/LICENSE", "no match"),
    (10, "m/COPYING", "Copyright (c) 2001 Ann Other\n\n" + MIT_BODY), (11, "m/src/main.c", "int main(void) { return 0; }"),
    (12, "g/three.sh", GPL_NOTICE.format(3)), (13, "g/two.sh", GPL_NOTICE.format(2).replace("software:", "software;")),
    (14, "p/readme.md", "Some prose about a project that does this and that. Released under the MIT License. And a sentence of prose that goes on."),
    (15, "p/spdx.c", "/* SPDX-License-Identifier: BSD-3-Clause */\nint x;"), (16, "p/other.c", "// SPDX-License-Identifier: Foo-1.0\nint y;"),
    (17, "b/LICENSE.txt", textwrap.fill(LONG["BSD-3-Clause"][0], 60)),
    (18, "b/licence-old", LONG["BSD-2-Clause"][0]), (19, "b/x/y.py", "pass"), (20, "l/lib.c", LONG["LGPL-2.1"][0].replace("*", "")),
    (21, "r/z.txt", "nothing"), (22, "e/LICENSE", ""), (23, "e/f.txt", "..."),
    (24, "q/prose.txt", "The license of this software is not stated. You may use the work under the public version of the general terms, in compliance with the law. " * 3),
    (25, "w/LICENSE", " ".join(f"{w} word{k}" if k % 4 == 0 else w for k, w in enumerate("".join(LONG["ISC"][1]).split()))),
]


def test_licenses_equal_brute_force(spark):
    frame = spark.createDataFrame(LICENSED, "doc_id long, path string, text string").withColumn("license", F.lit("x")).withColumn("whole", F.lit(1))
    rows = licenses.scan_licenses(frame, frame["path"]).collect()
    got = {r.doc_id: (r.own_license, r.own_score, r.license, r.inherited_from) for r in rows}
    want = license_by_hand(LICENSED)
    assert len(rows) == len(LICENSED) and {i: (a, c, d) for i, (a, _, c, d) in got.items()} == {i: (a, c, d) for i, (a, _, c, d) in want.items()}
    assert all(w[1] is None or abs(w[1] - got[i][1]) < 2e-9 for i, w in want.items())
    own = {i: v[0] for i, v in got.items()}
    assert {own[i] for i in (2, 4, 5, 8, 9, 11, 16, 19, 21, 22, 23, 24)} == {None}
    assert [own[i] for i in (1, 3, 6, 7)] == ["MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"]
    assert [own[i] for i in (10, 12, 13, 14, 15)] == ["MIT", "GPL-3.0", "GPL-2.0", "MIT", "BSD-3-Clause"]
    assert [own[i] for i in (17, 18, 20, 25)] == ["BSD-3-Clause", "BSD-2-Clause", "LGPL-2.1", "ISC"]
    assert got[2][2:] == ("MIT", "r") and got[4][2:] == ("Apache-2.0", "r/a/c") and got[11][2:] == ("MIT", "m") and got[23][2:] == (None, None)
    assert {r.doc_id: r.own_line for r in rows if r.doc_id in (1, 10, 12, 14)} == {1: 1, 10: 2, 12: 3, 14: 0}
    assert licenses.scan_licenses(frame.limit(0), frame["path"]).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("the mit license under gnu x y 2.0 3".split()), max_size=40), st.booleans())
def test_running_sums_equal_counted_runs(words, whole):
    templates = {"A": ("The *MIT* License under the",), "B": ("gnu gnu license *3* under the the gnu",), "C": ("2.0",)}
    text = "\n".join(words)
    want = license_by_hand([(1, "LICENSE" if whole else "x", text)], templates, 0.6)[1]
    frequency = dict.fromkeys(set(words), 1)
    got = licenses.Matcher(templates, frequency, 1, 0.6).scan(text, whole)
    assert (got and got[1]) == want[0] and (not got or abs(got[0] - want[1]) < 2e-9)


def test_license_far_into_a_long_text():
    matcher = licenses.Matcher(TEMPLATES, {}, 1000, licenses.LEAST)
    hit = matcher.scan("some words of prose\n" * 100_000 + GPL_NOTICE.format(3))
    assert hit and hit[1:] == ("GPL-3.0", 100_003) and hit[0] > 0.99


def test_language_vectors_stay_out_of_the_driver(table):
    """The driver gets centroids, not the vectors that they are fitted on (300 of 16 KB here)."""
    rng = random.Random(3)
    docs = table([(i, prose(rng, lang), lang, "a") for i, lang in enumerate(random.Random(4).choices(list(WORDS), k=450))])
    tracemalloc.start()
    try:
        model = language.fit_held_in(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.languages) == 9 and peak < 2_000_000
