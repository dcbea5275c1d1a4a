"""Set operations, upserts and order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column missing on one side becomes null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


concat_assessments = union_all


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows replace every existing row with the same key."""
    replaced = incoming.select(*key).distinct()
    return existing.join(replaced, list(key), "left_anti").unionByName(
        incoming, allowMissingColumns=True
    )


def insert_absent(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows are added only where their key is not there yet."""
    present = existing.select(*key).distinct()
    return existing.unionByName(
        incoming.join(present, list(key), "left_anti"), allowMissingColumns=True
    )


def distinct_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def common_strains(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("strain").intersect(b.select("strain"))


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key by ``order``.

    A struct minimum combines map-side, so a key with very many copies costs one
    row per input partition instead of one sorted group.
    """
    rest = [c for c in df.columns if c not in keys]
    ranks = [
        (F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)
    ]
    first = F.min(F.struct(*ranks, F.struct(*rest).alias("_row")))
    return df.groupBy(*keys).agg(first.alias("_first")).select(
        *keys, *[F.col(f"_first._row.{c}").alias(c) for c in rest]
    ).select(*df.columns)


def latest_state(events: DataFrame, key: Sequence[str], order: str = "attempt") -> DataFrame:
    """The most recent record per cell, kept only where it is a failure."""
    rest = [c for c in events.columns if c not in key]
    last = F.max(F.struct(F.col(order).alias("_o"), F.struct(*rest).alias("_row")))
    return (
        events.groupBy(*key)
        .agg(last.alias("_last"))
        .select(*key, *[F.col(f"_last._row.{c}").alias(c) for c in rest])
        .select(*events.columns)
        .where(F.col("exit_code") != 0)
    )


def canonical_order(df: DataFrame) -> DataFrame:
    """mapping_id, CHROM, POS, marker: a range-partitioned sort, for sinks only."""
    return df.orderBy("mapping_id", "CHROM", "POS", "marker")


def marker_order(df: DataFrame) -> DataFrame:
    """CHROM as text, POS as a number."""
    return df.orderBy("CHROM", F.col("POS").cast("long"))


def share(df: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Each row's part of its group's total."""
    totals = df.groupBy(*keys).agg(F.sum(n).alias("_total"))
    return df.join(totals, list(keys)).withColumn("pct", F.try_divide(F.col(n), F.col("_total"))).drop("_total")
