"""Detection and assessment of all mappings in one go."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from locuspark.operators import causal as causal_ops
from locuspark.operators import regions, variance
from locuspark.operators.intervals import detect
from locuspark.operators.queries import threshold_projection
from locuspark.operators.thresholds import mapping_thresholds, marker_set_thresholds
from locuspark.session import stage


class Processed(NamedTuple):
    regions: DataFrame
    summary: DataFrame
    thresholds: DataFrame


def process_mappings(
    mappings: DataFrame,
    metadata: DataFrame,
    ms_metadata: DataFrame,
    ids: DataFrame | None = None,
    methods: Sequence[str] = ("EIGEN",),
    alpha: float = 0.05,
    ci_size: int = 150,
    snp_grouping: int = 1000,
    user: float | None = None,
    missing: str = "fail",
) -> Processed:
    """Regions and summaries; here Bonferroni counts the marker set, not the rows.

    ``missing`` is that of ``mapping_thresholds``.
    """
    if ids is not None:
        chosen = ids.select("mapping_id").distinct()
        mappings = mappings.join(chosen, "mapping_id", "left_semi")
        metadata = metadata.join(chosen, "mapping_id", "left_semi")
    thresholds = mapping_thresholds(
        mappings, metadata, ms_metadata, methods, alpha, user, bf_count="marker_set", missing=missing
    )
    peaked, peaks = detect(mappings, thresholds, ci_size, snp_grouping)
    return Processed(
        regions.regions_from_peaks(peaks),
        regions.summary_from_detection(mappings, thresholds, peaked),
        thresholds,
    )


def analysis_bundle(
    joined: DataFrame, metadata: DataFrame, ms_metadata: DataFrame, alpha: float = 0.05
) -> DataFrame:
    """Mapping rows ready for threshold analysis, with both marker-set thresholds."""
    per_set = marker_set_thresholds(ms_metadata, alpha).select(
        "marker_set_id", "n_markers", "bf_threshold", "eigen_threshold"
    )
    per_mapping = metadata.select("mapping_id", "marker_set_id").join(per_set, "marker_set_id")
    return threshold_projection(joined).join(per_mapping.drop("marker_set_id"), "mapping_id", "left")


def compile_assessment(
    mappings: DataFrame,
    thresholds: DataFrame,
    peaks: DataFrame,
    metadata: DataFrame,
    causal: DataFrame,
    alpha: float,
    ci_size: int,
    snp_grouping: int,
) -> DataFrame:
    """Simulated and detected QTL of every arm in the 35-column layout.

    Scored variants, peaks and their overlaps feed several branches each and are
    staged; all three are small next to the mappings.
    """
    scored = stage(
        causal_ops.score_causal(mappings, thresholds, metadata, causal), "scored-causal"
    )
    peaks = stage(peaks, "peaks")
    overlaps = stage(causal_ops.peak_causal_overlaps(peaks, scored), "overlaps")
    missed = causal_ops.false_positive_peaks(peaks, overlaps, scored)
    union = causal_ops.assessment_union(scored, overlaps, missed)
    return causal_ops.assessment_columns(
        causal_ops.describe_cells(union, metadata, alpha, ci_size, snp_grouping)
    )


def assess(
    mappings: DataFrame,
    metadata: DataFrame,
    ms_metadata: DataFrame,
    traits: DataFrame,
    causal: DataFrame,
    genotypes: DataFrame,
    causal_genotypes: DataFrame,
    phenotypes: DataFrame,
    methods: Sequence[str] = ("BF", "EIGEN"),
    alpha: float = 0.05,
    ci_size: int = 150,
    snp_grouping: int = 1000,
    missing: str = "fail",
) -> DataFrame:
    """The full assessment: variance explained once per trait, then all arms.

    ``missing`` is that of ``mapping_thresholds``.
    """
    merged = variance.merge_genotypes(genotypes, causal_genotypes, causal, traits)
    explained = variance.variance_explained(variance.genotype_phenotype(merged, phenotypes))
    causal = stage(causal.join(explained, ["trait_id", "QTL"], "left"), "causal-explained")
    thresholds = stage(
        mapping_thresholds(mappings, metadata, ms_metadata, methods, alpha, missing=missing), "thresholds"
    )
    _peaked, peaks = detect(mappings, thresholds, ci_size, snp_grouping)
    return compile_assessment(
        mappings, thresholds, peaks, metadata, causal, alpha, ci_size, snp_grouping
    )
