"""Words of whole texts, and query items in blocks of about equal size."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, in UTF-8; only A-Z are lower-cased."""
    return _WORD.findall(text.encode().lower())


def word_places(text: str) -> list[tuple[int, int]]:
    """Start and end (exclusive) of every word, in bytes of the UTF-8 text."""
    return [m.span() for m in _WORD.finditer(text.encode().lower())]


def item_blocks(items: DataFrame, id_col: str, text_col: str, most_bytes: int) -> tuple[DataFrame, int]:
    """item_id, text, block of every item with a text, and how many blocks there are.

    Items are a stated set of queries that may have any size. What a task or the
    driver holds of them is one block: about ``most_bytes`` of text, or one longer item.
    """
    texts = items.select(items[id_col].alias("item_id"), items[text_col].cast("string").alias("text")).where("text is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-int(size) // most_bytes))
    return texts.withColumn("block", F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text"), F.lit(count)).cast("int")), count
