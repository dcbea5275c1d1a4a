"""Causal variants against detected peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions.names import algorithm_label
from locuspark.functions.scores import safe_log10p, significance_threshold
from locuspark.operators.blocks import POSITION_BLOCK, block_of
from locuspark.operators.intervals import ARM
from locuspark.operators.queries import select_or_null
from locuspark.operators.sets import dedup_first
from locuspark.schemas import ASSESSMENT

CAUSAL_COLUMNS = ("QTL", "CHROM", "POS", "RefAllele", "Frequency", "Effect")
OPTIONAL_COLUMNS = ("Simulated_QTL_VarExp",)
INTERVAL_COLUMNS = (
    "startPOS peakPOS endPOS detected_peak BETA interval_log10p interval_var_exp "
    "interval_Frequency peak_id interval_size"
).split()


def score_causal(
    mappings: DataFrame, thresholds: DataFrame, metadata: DataFrame, causal: DataFrame
) -> DataFrame:
    """Every causal variant of a mapping's trait with its score and flag, per arm.

    Variants that were never tested stay, with unknown score and flag. The
    mappings meet the causal table before thresholds fan out, so only causal
    markers are multiplied.
    """
    kept = [*CAUSAL_COLUMNS, *[c for c in OPTIONAL_COLUMNS if c in causal.columns]]
    of_mapping = metadata.select("mapping_id", "trait_id").join(
        causal.select("trait_id", *kept), "trait_id"
    )
    tested = mappings.select("mapping_id", F.col("marker").alias("QTL"), "P").join(
        of_mapping.select("mapping_id", "QTL").distinct(), ["mapping_id", "QTL"], "left_semi"
    )
    scores = (
        dedup_first(tested, ["mapping_id", "QTL"], ["P"])
        .withColumn("log10p", safe_log10p(F.col("P")))
        .drop("P")
    )
    return (
        of_mapping.join(scores, ["mapping_id", "QTL"], "left")
        .join(thresholds, "mapping_id")
        .withColumn(
            "significant", (F.col("log10p") >= F.col("sig_threshold_value")).cast("int")
        )
        .select(*ARM, *kept, "log10p", "significant")
    )


def peak_causal_overlaps(
    peaks: DataFrame, scored: DataFrame, width: int = POSITION_BLOCK
) -> DataFrame:
    """Causal variants inside a peak's interval, both ends included.

    A range join turned into an equi-join on position blocks: an interval is
    listed under each block it touches, a variant lies in exactly one, so pairs
    are neither lost nor doubled and far-apart ones never meet.
    """
    spans = peaks.select(
        *ARM,
        "CHROM",
        "startPOS",
        "peakPOS",
        "endPOS",
        F.col("peak_marker").alias("detected_peak"),
        F.col("peak_BETA").alias("BETA"),
        F.col("max_log10p").alias("interval_log10p"),
        F.lit(None).cast("double").alias("interval_var_exp"),
        F.col("peak_AF1").alias("interval_Frequency"),
        "peak_id",
        "interval_size",
        F.explode(
            F.sequence(block_of(F.col("startPOS"), width), block_of(F.col("endPOS"), width))
        ).alias("_block"),
    )
    points = scored.withColumn("_block", block_of(F.col("POS"), width))
    return (
        spans.join(points, [*ARM, "CHROM", "_block"])
        .where(F.col("POS").between(F.col("startPOS"), F.col("endPOS")))
        .drop("_block")
    )


def false_positive_peaks(
    peaks: DataFrame, overlaps: DataFrame, scored: DataFrame
) -> DataFrame:
    """Peaks without any causal variant; the peak marker stands in as the QTL.

    An arm whose trait has no causal variants at all yields none.
    """
    with_causal = scored.select(*ARM).distinct()
    return (
        peaks.join(with_causal, list(ARM), "left_semi")
        .join(overlaps.select(*ARM, "peak_id").distinct(), [*ARM, "peak_id"], "left_anti")
        .select(
            *ARM,
            F.col("peak_marker").alias("QTL"),
            "CHROM",
            F.col("peakPOS").alias("POS"),
            "startPOS",
            "peakPOS",
            "endPOS",
            F.col("peak_marker").alias("detected_peak"),
            F.col("peak_BETA").alias("BETA"),
            F.col("max_log10p").alias("interval_log10p"),
            F.lit(None).cast("double").alias("interval_var_exp"),
            F.col("peak_AF1").alias("interval_Frequency"),
            "peak_id",
            "interval_size",
        )
    )


def first_overlap(overlaps: DataFrame) -> DataFrame:
    """A variant inside several peaks keeps the one with the lowest peak id."""
    return dedup_first(
        overlaps.select(*ARM, "QTL", *INTERVAL_COLUMNS), [*ARM, "QTL"], ["peak_id"]
    )


def assessment_union(
    scored: DataFrame, overlaps: DataFrame, false_positives: DataFrame
) -> DataFrame:
    """One row per arm and QTL, simulated or detected or both."""
    simulated = dedup_first(scored, [*ARM, "QTL"], ["CHROM", "POS"]).withColumn(
        "_simulated", F.lit(True)
    )
    found = (
        first_overlap(overlaps)
        .withColumns(
            {"_chrom": F.lit(None).cast("string"), "_pos": F.lit(None).cast("long")}
        )
        .unionByName(
            false_positives.withColumns({"_chrom": F.col("CHROM"), "_pos": F.col("POS")}).drop(
                "CHROM", "POS"
            )
        )
        .withColumn("_detected", F.lit(True))
    )
    return (
        simulated.join(found, [*ARM, "QTL"], "full")
        .withColumns(
            {
                "CHROM": F.coalesce("CHROM", "_chrom"),
                "POS": F.coalesce("POS", "_pos"),
                "Simulated": F.coalesce("_simulated", F.lit(False)),
                "Detected": F.coalesce("_detected", F.lit(False)),
                "top_hit": F.col("QTL") == F.col("detected_peak"),
            }
        )
        .drop("_chrom", "_pos", "_simulated", "_detected")
    )


def describe_cells(
    union: DataFrame, metadata: DataFrame, alpha: float, ci_size: int, snp_grouping: int
) -> DataFrame:
    """Add the simulation parameters, as text where the output keeps them as text."""
    cells = metadata.select(
        "mapping_id",
        F.col("nqtl").cast("string").alias("nQTL"),
        F.col("rep").cast("string").alias("simREP"),
        F.col("h2").cast("string").alias("h2"),
        F.col("maf").cast("string").alias("maf"),
        F.col("effect").alias("effect_distribution"),
        F.col("population").alias("strain_set_id"),
        F.col("algorithm").alias("mode"),
        F.when(F.col("pca"), "pca").otherwise("nopca").alias("type"),
        "algorithm",
        "pca",
    )
    return (
        union.join(cells, "mapping_id")
        .withColumns(
            {
                "threshold": F.col("sig_threshold_method"),
                "algorithm_id": algorithm_label(
                    F.col("algorithm"), F.col("pca"), F.col("sig_threshold_method")
                ),
                "alpha": F.lit(float(alpha)),
                "ci_size": F.lit(ci_size),
                "snp_grouping": F.lit(snp_grouping),
            }
        )
        .drop("algorithm", "pca", "sig_threshold_method")
    )


def assessment_columns(df: DataFrame) -> DataFrame:
    """The 35 assessment columns in order; absent ones become null."""
    return select_or_null(df, [(f.name, f.dataType.simpleString()) for f in ASSESSMENT.fields])


def causal_pvalues(
    causal: DataFrame,
    mappings: DataFrame,
    metadata: DataFrame,
    ms_metadata: DataFrame,
    thresholds: Sequence[str] = ("BF", "EIGEN"),
    alpha: float = 0.05,
) -> DataFrame:
    """P-value and detection at each causal variant of each mapping, per threshold.

    Detection is strict (``>``) and false where the variant was not tested.
    Thresholds other than BF and EIGEN are numbers written as text. Mappings
    listed in metadata but without stored rows are left out.
    """
    stored = metadata.join(
        mappings.select("mapping_id").distinct(), "mapping_id", "left_semi"
    ).select("mapping_id", "trait_id", "marker_set_id", "population", "algorithm", "pca")
    pairs = stored.join(
        causal.select("trait_id", "QTL", "CHROM", "POS").distinct(), "trait_id"
    )
    hits = mappings.select("mapping_id", F.col("marker").alias("QTL"), "P").join(
        pairs.select("mapping_id", "QTL"), ["mapping_id", "QTL"], "left_semi"
    )
    values = {
        "BF": significance_threshold(F.col("n_markers"), alpha),
        "EIGEN": significance_threshold(F.col("n_independent_tests"), alpha),
    }
    arms = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("threshold"),
                    values.get(name, F.lit(name).try_cast("double")).alias("threshold_value"),
                )
                for name in thresholds
            ]
        )
    )
    per_set = ms_metadata.select("marker_set_id", arms.alias("_arm")).select(
        "marker_set_id", "_arm.threshold", "_arm.threshold_value"
    )
    return (
        pairs.join(dedup_first(hits, ["mapping_id", "QTL"], ["P"]), ["mapping_id", "QTL"], "left")
        .withColumn("log10p", safe_log10p(F.col("P")))
        .join(per_set, "marker_set_id", "left")
        .withColumn(
            "detected",
            F.when(F.col("log10p").isNotNull(), F.col("log10p") > F.col("threshold_value")).otherwise(
                F.lit(False)
            ),
        )
        .select(
            "trait_id",
            "population",
            "mapping_id",
            "algorithm",
            "pca",
            "threshold",
            "threshold_value",
            "QTL",
            "CHROM",
            "POS",
            "P",
            "log10p",
            "detected",
        )
    )
