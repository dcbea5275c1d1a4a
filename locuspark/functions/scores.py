"""Numeric and positional column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the score given to a p-value whose logarithm is infinite.
LOG10P_MAX = 300.0


def clean_number(c: Column) -> Column:
    """NaN becomes null, so that comparisons with it are unknown, not true."""
    return F.when(~F.isnan(c), c)


def safe_log10p(p: Column) -> Column:
    """-log10(p); an infinite result becomes 300, null and NaN stay unknown.

    Spark's ``log10`` is null at zero, so both infinities are spelled out.
    """
    infinite = (p == F.lit(0.0)) | (p == F.lit(float("inf")))
    return F.when(F.isnan(p), None).when(infinite, F.lit(LOG10P_MAX)).otherwise(-F.log10(p))


def significance_threshold(tests: Column, alpha: float) -> Column:
    """-log10(alpha / tests); null when there are no tests to correct for."""
    return F.when(tests > 0, -F.log10(F.lit(float(alpha)) / tests))


def split_marker(marker: Column) -> Column:
    """``CHROM:POS`` as struct<chrom string, pos bigint>."""
    return F.struct(
        F.substring_index(marker, ":", 1).alias("chrom"),
        F.substring_index(marker, ":", -1).try_cast("long").alias("pos"),
    )


def make_marker(chrom: Column, pos: Column) -> Column:
    return F.concat_ws(":", chrom.cast("string"), pos.cast("string"))


def with_position(df: DataFrame, marker: str = "marker") -> DataFrame:
    """Add CHROM and POS taken from the marker string; no join with the marker table."""
    parts = split_marker(F.col(marker))
    return df.withColumns({"CHROM": parts["chrom"], "POS": parts["pos"]})


def interval_jaccard(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Shared length over spanned length; two equal points count as 1."""
    shared = F.greatest(F.lit(0), F.least(end_a, end_b) - F.greatest(start_a, start_b))
    spanned = F.greatest(end_a, end_b) - F.least(start_a, start_b)
    return F.when(spanned == 0, F.lit(1.0)).otherwise(shared / spanned)
