"""The older interval and assessment path, for comparison with the current one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.operators import genotype as G
from locuspark.operators import legacy as L
from locuspark.operators import variance
from locuspark.operators.blocks import POSITION_BLOCK, block_of
from locuspark.operators.intervals import detect, ensure_position, flag_significant
from locuspark.session import stage


def legacy_intervals(
    mappings: DataFrame,
    metadata: DataFrame,
    genotypes: DataFrame,
    phenotypes: DataFrame,
    method: str = "BF",
    alpha: float = 0.05,
    ci_size: int = 150,
    snp_grouping: int = 1000,
    max_share: float = L.MAX_SHARE,
    tests: DataFrame | None = None,
    user: float | None = None,
) -> DataFrame:
    """Scored rows; a significant marker once per strain, its peak row with the interval.

    Rows with an unknown or zero score drop out first. Where too many markers
    are significant (or none is) all added columns stay null.
    """
    rows = ensure_position(L.scored(mappings))
    thresholds = stage(L.legacy_thresholds(rows, method, alpha, tests, user), "legacy-thresholds")
    flagged = flag_significant(rows, thresholds)
    reported = stage(L.share_guard(flagged, max_share), "legacy-guard")
    kept = rows.join(reported, "mapping_id", "left_semi")
    _peaked, peaks = detect(kept, thresholds, ci_size, snp_grouping)

    meta = metadata.select("mapping_id", "trait_id", "marker_set_id")
    hits = (
        flagged.where(F.col("significant") == 1)
        .join(reported, "mapping_id", "left_semi")
        .select("mapping_id", "marker", "CHROM", "POS")
        .join(meta, "mapping_id")
    )
    # Every phenotyped strain appears at a significant marker, typed or not.
    by_strain = hits.join(
        phenotypes.select("trait_id", "strain", F.col("phenotype").alias("value")), "trait_id"
    ).join(
        G.complete_markers(genotypes).select("marker_set_id", "CHROM", "POS", "strain", "allele"),
        ["marker_set_id", "CHROM", "POS", "strain"],
        "left",
    )
    explained = variance.marker_r2(
        by_strain.withColumn("phenotype", F.col("value")), ("mapping_id", "marker")
    )
    strains = by_strain.select("mapping_id", "marker", "strain", "value", "allele").join(
        explained, ["mapping_id", "marker"]
    )
    tops = peaks.select(
        "mapping_id",
        F.col("peak_marker").alias("marker"),
        "startPOS",
        "peakPOS",
        "endPOS",
        "peak_id",
        "interval_size",
    )
    return (
        flagged.withColumnsRenamed({"significant": "aboveBF", "sig_threshold_value": "BF"})
        .drop("sig_threshold_method")
        .join(strains, ["mapping_id", "marker"], "left")
        .join(tops, ["mapping_id", "marker"], "left")
    )


def legacy_assessment(
    intervals: DataFrame,
    metadata: DataFrame,
    causal: DataFrame,
    genotypes: DataFrame,
    phenotypes: DataFrame,
    traits: DataFrame,
    width: int = POSITION_BLOCK,
) -> DataFrame:
    """Simulated and detected QTL per mapping from :func:`legacy_intervals`.

    Causal variants without a score vanish, and a variant inside several peaks
    keeps one row per peak.
    """
    positions = causal.join(traits.select("trait_id", "marker_set_id"), "trait_id").select(
        "trait_id", "marker_set_id", "CHROM", "POS", "QTL"
    )
    typed = positions.join(genotypes, ["marker_set_id", "CHROM", "POS"]).join(
        phenotypes, ["trait_id", "strain"]
    )
    explained = variance.marker_r2(typed, ("trait_id", "QTL")).withColumnRenamed(
        "var_exp", "Simulated_QTL_VarExp"
    )
    effects = causal.join(explained, ["trait_id", "QTL"], "left")

    markers = intervals.select(
        "mapping_id", F.col("marker").alias("QTL"), "log10p", F.col("aboveBF").alias("significant")
    )
    scores = stage(
        metadata.select("mapping_id", "trait_id")
        .join(effects, "trait_id")
        .join(markers, ["mapping_id", "QTL"])
        .dropDuplicates(["mapping_id", "QTL"])
        .drop("trait_id"),
        "legacy-scores",
    )
    peaks = stage(
        intervals.where(F.col("peak_id").isNotNull())
        .select(
            "mapping_id",
            "CHROM",
            F.col("marker").alias("detected_peak"),
            "BETA",
            F.col("log10p").alias("interval_log10p"),
            F.col("var_exp").alias("interval_var_exp"),
            F.col("AF1").alias("interval_Frequency"),
            "startPOS",
            "peakPOS",
            "endPOS",
            "peak_id",
            "interval_size",
        )
        .distinct(),
        "legacy-peaks",
    )
    spans = peaks.withColumn(
        "_block",
        F.explode(
            F.sequence(block_of(F.col("startPOS"), width), block_of(F.col("endPOS"), width))
        ),
    )
    inside = (
        spans.join(
            scores.select("mapping_id", "CHROM", "POS", "QTL").withColumn(
                "_block", block_of(F.col("POS"), width)
            ),
            ["mapping_id", "CHROM", "_block"],
        )
        .where(F.col("POS").between(F.col("startPOS"), F.col("endPOS")))
        .select("mapping_id", "peak_id", "QTL")
    )
    overlap = (
        peaks.join(inside, ["mapping_id", "peak_id"], "left")
        .withColumn("QTL", F.coalesce("QTL", "detected_peak"))
        .drop("CHROM")
        .withColumn("_detected", F.lit(True))
    )
    return (
        scores.withColumn("_simulated", F.lit(True))
        .join(overlap, ["mapping_id", "QTL"], "full")
        .withColumns(
            {
                "Simulated": F.coalesce("_simulated", F.lit(False)),
                "Detected": F.coalesce("_detected", F.lit(False)),
                "top_hit": F.col("QTL") == F.col("detected_peak"),
            }
        )
        .drop("_simulated", "_detected")
    )
