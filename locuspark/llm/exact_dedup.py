"""Exact duplicates by a 128-bit content hash, checked byte by byte.

Plan: a narrow table (id, hash) is grouped with map-side sums, so a text with
very many copies costs one partial row per task. Only texts whose hash occurs
more than once are read again and compared with the text of the row that stays;
texts that differ from it although their hashes agree go through another round
among themselves, until none is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import add, stage, text_of

BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one space."""
    return F.regexp_replace(text, BLANKS, " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    A null text equals an empty one. Null ids come after all others, so they
    stay only where a group has nothing else. A row that occurs several times
    counts each time, and one of its copies is kept at most. An empty table
    gives an empty result. Other columns are ignored.
    """
    keyed = text_of(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("norm"))
    keyed = keyed.withColumns({"h": hash_of(F.col("norm")), "sha": F.unhex(F.sha2(F.col("norm"), 256))})
    rows = stage(keyed.groupBy("doc_id", "h", "sha").agg(F.count(F.lit(1)).alias("n")), "dedup-rows")
    texts = keyed
    done: DataFrame | None = None
    while True:
        groups = stage(
            rows.groupBy("h").agg(
                F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "sha")).alias("first"),
                F.sum("n").alias("group_size"),
                F.count(F.lit(1)).alias("members"),
            ),
            "dedup-groups",
        )
        shared = groups.where("members > 1").select("h", "first")
        copies = stage(texts.join(shared, "h").select("doc_id", "h", "sha", "norm", "first"), "dedup-texts")
        is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("sha") == F.col("first.sha"))
        stays = stage(copies.where(is_first).dropDuplicates(["h"]).select("h", F.col("norm").alias("kept_norm")), "dedup-stays")
        unlike = stage(
            copies.join(stays, "h").where("norm != kept_norm").select("doc_id", "h", "sha", "norm"), "dedup-unlike"
        )
        if unlike.isEmpty():
            return _result(add(done, _members(rows, groups)))
        left = stage(unlike.select(*[F.col(c).alias(f"u_{c}") for c in ("doc_id", "h", "sha")]).distinct(), "dedup-left")
        is_left = (F.col("h") == F.col("u_h")) & (F.col("sha") == F.col("u_sha")) & F.col("doc_id").eqNullSafe(F.col("u_doc_id"))
        settled = stage(rows.join(left, is_left, "left_anti"), "dedup-settled")
        sizes = stage(settled.groupBy("h").agg(F.sum("n").alias("group_size")), "dedup-sizes")
        done = add(done, _members(settled, groups.drop("group_size").join(sizes, "h")))
        rows, texts = stage(rows.join(left, is_left, "left_semi"), "dedup-open"), unlike


def _members(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups.select("h", "first", "group_size"), "h")


def _result(members: DataFrame) -> DataFrame:
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return members.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (first & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, in one copy each."""
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("kept_id"), F.unhex("text_sha256").alias("kept_sha"))
    kept = stage(kept, "dedup-kept")
    sha = F.unhex(F.sha2(normalised(F.coalesce(docs[text_col].cast("string"), F.lit(""))), 256))
    same = docs[id_col].eqNullSafe(kept["kept_id"]) & (sha == kept["kept_sha"])
    found = docs.join(kept, same, "left_semi")
    # Only rows whose id occurs more than once can still be double.
    return one_copy(found, id_col, text_col, F.sha2(normalised(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), 256)) if _repeated(docs, id_col) else found


def one_copy(found: DataFrame, id_col: str, text_col: str, content: Column) -> DataFrame:
    """One row of those with the same id (null ids are alike) and content: the smallest text, then the smallest hash of the row."""
    rest = F.xxhash64(*[F.col(c) for c, kind in found.dtypes if "map<" not in kind])
    row = F.struct(*[F.col(c) for c in found.columns])
    kept = found.groupBy(F.col(id_col).alias("of_id"), content.alias("of_content")).agg(F.min_by(row, F.struct(F.col(text_col), rest)).alias("row"))
    return kept.select("row.*")


def _repeated(docs: DataFrame, id_col: str) -> bool:
    return not docs.groupBy(id_col).count().where("count > 1").isEmpty()
