"""Operators of the older, file-based interval and assessment path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.functions.scores import safe_log10p, significance_threshold
from locuspark.operators.blocks import marker_index, running_total

# Fixed value: above this share of significant markers no interval is reported.
MAX_SHARE = 0.15


def drop_zero_log10p(df: DataFrame) -> DataFrame:
    """Rows with a known, non-zero score."""
    return df.where(F.col("log10p") != 0)


def scored(mappings: DataFrame) -> DataFrame:
    return drop_zero_log10p(mappings.withColumn("log10p", safe_log10p(F.col("P"))))


def legacy_thresholds(
    rows: DataFrame,
    method: str = "BF",
    alpha: float = 0.05,
    tests: DataFrame | None = None,
    user: float | None = None,
) -> DataFrame:
    """One threshold per mapping.

    BF counts positive scores only; EIGEN takes n_tests per mapping from
    ``tests``; USER is a number.
    """
    if method == "BF":
        counted = rows.groupBy("mapping_id").agg(
            F.count(F.when(F.col("log10p") > 0, 1)).alias("_n")
        )
        value: Column = significance_threshold(F.col("_n"), alpha)
    elif method == "EIGEN":
        counted = tests.select("mapping_id", F.col("n_tests").alias("_n"))
        value = significance_threshold(F.col("_n"), alpha)
    elif method == "USER":
        counted = rows.select("mapping_id").distinct()
        value = F.lit(float(user))
    else:
        raise ValueError(f"unknown significance method: {method}")
    return counted.select(
        "mapping_id",
        F.lit(method).alias("sig_threshold_method"),
        value.alias("sig_threshold_value"),
    )


def share_guard(flagged: DataFrame, max_share: float = MAX_SHARE) -> DataFrame:
    """Mappings whose intervals are reported: some, but under ``max_share``, significant."""
    counts = flagged.groupBy("mapping_id").agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum("significant"), F.lit(0)).alias("_sig")
    )
    return counts.where(
        (F.col("_sig") > 0) & (F.col("_sig") < F.col("_n") * F.lit(max_share))
    ).select("mapping_id")


def running_significant(flagged: DataFrame) -> DataFrame:
    """index along the chromosome, running count of significant markers, and their total."""
    keys = ("mapping_id",)
    indexed = marker_index(flagged, keys).withColumnRenamed("marker_index", "index")
    running = running_total(indexed, keys, F.col("significant"), "peaks")
    totals = flagged.groupBy("mapping_id", "CHROM").agg(F.sum("significant").alias("nBF"))
    return running.join(totals, ["mapping_id", "CHROM"])
