from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from locuspark.llm import language, mixing, packing
from locuspark.llm.common import small_table
from tests.llm.test_duplicates import near_by_hand, norm


def test_first_stages_against_plain_python(spark, table):
    """Null and repeated ids, an unseen script, equal texts and near copies with a repeated line."""
    rng = random.Random(4)
    line = "the same line again and again "
    clean = []
    for i in range(40):
        words = " ".join(f"{rng.choice(['thing', 'whether', 'ing', 'and'])}{rng.choice('aeiou')}{rng.choice('rst')}" for _ in range(120))
        clean += [(3 * i, words, "en", "a"), (3 * i + 1, line * 2 + words, "en", "a"), (3 * i + 2, line * 12 + words, "en", "b")]
    clean += [(500, clean[0][1].replace(" ", "  "), "en", "b"), (0, "whether other text of the same id and thing", "en", "a"), (None, "thing and whether one without id", "en", "a"), (None, "thing and whether two without id", "en", "b")]
    docs = table(clean + [(901, "漢字かな交じり文" * 9, None, "a"), (902, "12 34", "en", "a")])
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: Counter((r.doc_id, norm(r.text)) for r in df.collect())

    known = stages["language_id"](spark, docs, "").cache()
    assert rows(known) == Counter((i, norm(t)) for i, t, *_ in clean)

    exact = stages["exact_duplicates"](spark, known, "").cache()
    first = {}
    for i, t, *_ in sorted(clean, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(norm(t), i)
    assert rows(exact) == Counter((i, t) for t, i in first.items())

    numbered = sorted(((i, t) for t, i in first.items()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    root = near_by_hand(list(enumerate(t for _, t in numbered)))
    assert rows(stages["near_duplicates"](spark, exact, "")) == Counter(numbered[k] for k in set(root.values()))


def test_stages_leave_columns_with_their_own_names_alone(spark):
    """Input columns bear the names that the stages use themselves."""
    names = ["lang_pred", "lang_score", "lang_rejected", "row", "lo", "hi", "rest", "full", "docs", "sources", "mix_copies", "mix_size", "mix_pattern", "mix_key", "mix_doc_id", "pattern"]
    text = "the house by the river was old and the people of the town knew every room of it"
    rows = [(k, f"{text} number {k} " * 3, "en", "ab"[k % 2], *range(100 * k, 100 * k + len(names))) for k in range(12)]
    frame = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "lang string", "source string", *[f"{c} long" for c in names]]))
    for stage in (language.recognised, mixing.mixed):
        got = stage(frame)
        assert got.columns == frame.columns
        found = {tuple(r) for r in got.collect()}
        assert found and found <= set(rows)
    mixed = mixing.mix(frame, F.when(F.col("doc_id") > 0, F.array("source"))).collect()
    assert len(mixed) == 12 and [(r.mix_copies, r.lo) for r in mixed if r.doc_id == 0] == [(0, 4)]
    assert all(r.mix_size == len(r.text.split()) for r in mixed)


def test_rows_of_the_driver_pass_through_no_python_tasks(spark, table, monkeypatch):
    """Their workers are others than those of Arrow tasks and would stay beside them."""
    docs = table([(i, f"one of the texts {i} " * (i % 9 + 1), "en", "ab"[i % 2]) for i in range(60)])

    def refused(*args, **options):
        raise AssertionError("rows of the driver given to Python tasks")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    assert packing.pack(docs).select("doc_id").distinct().count() == 60
    assert mixing.mixed(docs).count() > 0
    rows = [("a", 1, [("b", 2, 0.5), (None, None, None)]), (None, None, None), ("c", 3, [])]
    schema = "k string, n long, s array<struct<name: string, size: long, target: double>>"
    assert [tuple(r) for r in small_table(spark, rows, schema).collect()] == rows
    assert small_table(spark, [], schema).count() == 0
