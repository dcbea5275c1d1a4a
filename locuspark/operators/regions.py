"""Region tables and detection summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.operators.intervals import ARM

REGION_COLUMNS = (
    "mapping_id sig_threshold_method peak_id CHROM startPOS peakPOS endPOS interval_size "
    "n_sig_markers max_log10p peak_marker sig_threshold_value"
).split()


def qtl_regions(analyzed: DataFrame) -> DataFrame:
    """One row per peak of an analyzed frame."""
    top = F.max(
        F.struct(F.col("log10p"), (-F.col("POS")).alias("_rank"), F.col("marker"))
    )
    first = ["startPOS", "peakPOS", "endPOS", "interval_size", "sig_threshold_value"]
    return (
        analyzed.where(F.col("peak_id").isNotNull())
        .groupBy(*ARM, "peak_id", "CHROM")
        .agg(
            *[F.max(c).alias(c) for c in first],
            F.sum("significant").cast("int").alias("n_sig_markers"),
            top.alias("_top"),
        )
        .select(
            *[
                F.col("_top.log10p").alias(c)
                if c == "max_log10p"
                else F.col("_top.marker").alias(c)
                if c == "peak_marker"
                else F.col(c)
                for c in REGION_COLUMNS
            ]
        )
    )


def regions_from_peaks(peaks: DataFrame) -> DataFrame:
    """The same table straight from :func:`detect`, without the full analyzed frame."""
    return peaks.select(*REGION_COLUMNS)


def region_records(
    regions: DataFrame, metadata: DataFrame, ci_size: int, snp_grouping: int
) -> DataFrame:
    """Regions with the mapping's parameters, in the stored column layout."""
    return regions.join(
        metadata.select("mapping_id", "algorithm", "population", "maf"), "mapping_id"
    ).select(
        "mapping_id",
        F.col("sig_threshold_method").alias("threshold_method"),
        "peak_id",
        "CHROM",
        "startPOS",
        "peakPOS",
        "endPOS",
        "interval_size",
        "n_sig_markers",
        "max_log10p",
        "peak_marker",
        "sig_threshold_value",
        F.lit(ci_size).alias("ci_size"),
        F.lit(snp_grouping).alias("snp_grouping"),
        "algorithm",
        "population",
        "maf",
    )


def detection_summary(analyzed: DataFrame) -> DataFrame:
    """Per arm: markers, significant markers and their share, peaks, top score, threshold.

    Peak ids run from 1 without gaps, so their maximum is their count.
    """
    n_sig = F.coalesce(F.sum("significant"), F.lit(0))
    return (
        analyzed.groupBy(*ARM)
        .agg(
            F.count(F.lit(1)).alias("n_markers"),
            n_sig.alias("n_significant"),
            F.bround(100.0 * n_sig / F.count(F.lit(1)), 2).alias("pct_significant"),
            F.coalesce(F.max("peak_id"), F.lit(0)).alias("n_qtl"),
            F.bround(F.max("log10p"), 4).alias("max_log10p"),
            F.first("sig_threshold_value").alias("threshold_value"),
        )
        .withColumnRenamed("sig_threshold_method", "threshold_method")
    )


def summary_from_detection(
    mappings: DataFrame, thresholds: DataFrame, peaked: DataFrame
) -> DataFrame:
    """Detection summary without building the analyzed frame.

    Row counts and top scores are per mapping, so thresholds fan out only after
    that aggregation.
    """
    from locuspark.functions.scores import safe_log10p

    per_mapping = mappings.groupBy("mapping_id").agg(
        F.count(F.lit(1)).alias("n_markers"),
        F.max(safe_log10p(F.col("P"))).alias("_max"),
    )
    per_arm = peaked.groupBy(*ARM).agg(
        F.count(F.lit(1)).alias("_sig"), F.max("peak_id").alias("_qtl")
    )
    n_sig = F.coalesce("_sig", F.lit(0))
    return (
        thresholds.join(per_mapping, "mapping_id")
        .join(per_arm, list(ARM), "left")
        .select(
            "mapping_id",
            F.col("sig_threshold_method").alias("threshold_method"),
            "n_markers",
            n_sig.alias("n_significant"),
            F.bround(100.0 * n_sig / F.col("n_markers"), 2).alias("pct_significant"),
            F.coalesce("_qtl", F.lit(0)).alias("n_qtl"),
            F.bround("_max", 4).alias("max_log10p"),
            F.col("sig_threshold_value").alias("threshold_value"),
        )
    )
