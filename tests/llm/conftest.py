from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kind string, sha string, part int, pattern string"


@pytest.fixture
def table(spark: SparkSession):
    """Documents from (doc_id, text, lang, source); further columns bear names the operators use themselves."""

    def build(rows) -> DataFrame:
        full = [(*r, *[None] * (4 - len(r)), None, "k", "s", 1, "p") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n ", "en", "a"),
    (4, "one", "en", None),
    (5, "word " * 30_000, "en", "b"),
    (6, "ünïcode 　 text \U0001f600 12", "de", "b"),
    (6, "ünïcode 　 text \U0001f600 12", "de", "b"),
    (None, "no id here", None, "b"),
]
