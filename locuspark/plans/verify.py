"""Completeness of a result database against an expected parameter grid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions.ids import with_ids
from locuspark.operators import grid as G

MAPPING_CELL = ("population", "nqtl", "h2", "effect", "algorithm", "pca")
TRAIT_CELL = ("population", "nqtl", "h2", "effect")

# Component names and the unit each is counted against.
COMPONENTS = {
    "marker_sets_markers": "marker_set",
    "marker_sets_genotypes": "marker_set",
    "marker_set_metadata": "marker_set",
    "traits_metadata_files": "trait",
    "causal_variants_files": "trait",
    "phenotypes_files": "trait",
    "causal_genotypes_files": "trait",
    "mapping_data_files": "mapping",
    "mapping_meta_files": "mapping",
    "mappings_metadata_rows": "mapping",
}


@dataclass(frozen=True)
class Expectation:
    """What the database should hold: groups, value lists and the causal-pool limits."""

    groups: DataFrame
    nqtl: Sequence[int]
    h2: Sequence[float]
    effect: Sequence[str]
    reps: int
    cv_maf: float | None = None
    cv_ld: float | None = None
    algorithm: Sequence[str] = ("inbred", "loco")
    pca: Sequence[bool] = (True, False)


def expected_cells(e: Expectation, per_trait: bool = False) -> DataFrame:
    out = G.parameter_grid(
        e.groups.select("population"),
        e.nqtl,
        e.effect,
        e.h2,
        1,
        None if per_trait else e.algorithm,
        None if per_trait else e.pca,
    )
    return out.drop("rep").distinct().withColumn("expected", F.lit(e.reps))


def expected_ids(e: Expectation) -> DataFrame:
    """trait_id and mapping_id of every expected run in groups whose marker set is known.

    Hashing is a column expression, so the grid may be of any size.
    """
    known = e.groups.where(F.col("marker_set_metadata_present")).select(
        "population", "maf", "species", "vcf_release_id", "ms_ld"
    )
    runs = G.parameter_grid(known, e.nqtl, e.effect, e.h2, e.reps, e.algorithm, e.pca)
    return with_ids(
        runs.withColumns(
            {
                "cv_maf_effective": F.lit(e.cv_maf).cast("double"),
                "cv_ld": F.lit(e.cv_ld).cast("double"),
            }
        )
    )


def component_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct units present per component: component, observed."""
    parts = [
        df.agg(F.countDistinct(key).alias("observed")).select(
            F.lit(name).alias("component"), "observed"
        )
        for name, (df, key) in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def component_summary(counts: DataFrame, expected: Mapping[str, int] | None = None) -> DataFrame:
    """Expected, observed, missing and completeness (capped at 1) per component."""
    want = F.lit(None).cast("long")
    if expected is not None:
        for component, unit in COMPONENTS.items():
            want = F.when(F.col("component") == component, F.lit(expected[unit]).cast("long")).otherwise(want)
    return counts.withColumn("expected", want).select(
        "component",
        "expected",
        F.col("observed").cast("long").alias("observed"),
        F.greatest(F.col("expected") - F.col("observed"), F.lit(0)).alias("missing"),
        F.when(
            F.col("expected") > 0,
            F.least(F.col("observed") / F.col("expected"), F.lit(1.0)),
        ).alias("pct_complete"),
    )


def marker_set_coverage(groups: DataFrame, markers: DataFrame, genotypes: DataFrame) -> DataFrame:
    """Per group: are metadata, markers and genotypes there?"""
    has_markers = markers.select("marker_set_id").distinct().withColumn("_m", F.lit(True))
    has_genotypes = genotypes.select("marker_set_id").distinct().withColumn("_g", F.lit(True))
    return (
        groups.join(has_markers, "marker_set_id", "left")
        .join(has_genotypes, "marker_set_id", "left")
        .select(
            "population",
            "maf",
            "marker_set_id",
            F.col("marker_set_id").isNotNull().alias("metadata_row_exists"),
            F.coalesce("_m", F.lit(False)).alias("markers_exist"),
            F.coalesce("_g", F.lit(False)).alias("genotypes_exist"),
            "n_markers",
            "n_independent_tests",
        )
    )


def status_of(
    summary: DataFrame, n_observed: int, expectation: bool, complete_args: bool, n_errors: int = 0
) -> DataFrame:
    """One row with the overall status."""
    missing = F.coalesce(F.max(F.when(F.col("missing") > 0, 1)), F.lit(0))
    if n_observed == 0 and n_errors > 0:
        status = F.lit("error")
    elif not expectation:
        status = F.lit("discovery")
    elif not complete_args:
        status = F.lit("incomplete")
    else:
        status = F.when((missing == 1) | F.lit(n_errors > 0), "incomplete").otherwise("complete")
    return summary.agg(status.alias("status"))


def verify(
    metadata: DataFrame,
    component_tables: Mapping[str, tuple[DataFrame, str]],
    markers: DataFrame,
    genotypes: DataFrame,
    expectation: Expectation | None = None,
) -> dict[str, DataFrame]:
    """All verification tables; without an expectation only what is there is described."""
    cells = G.observed_cells(metadata)
    counts = component_counts(component_tables)
    out = {
        "observed_mappings": cells,
        "observed_traits": G.observed_traits(cells),
        "observed_grid": G.observed_grid(cells),
    }
    if expectation is None:
        summary = component_summary(counts)
        return {**out, "summary": summary, "status": status_of(summary, 1, False, False)}
    e = expectation
    n_groups = e.groups.count()
    n_traits = n_groups * len(e.nqtl) * len(e.h2) * len(e.effect) * e.reps
    n_mappings = n_traits * len(e.algorithm) * len(e.pca)
    summary = component_summary(
        counts, {"marker_set": n_groups, "trait": n_traits, "mapping": n_mappings}
    )
    out["mappings_delta"] = G.cell_delta(
        expected_cells(e), cells, MAPPING_CELL, observed_col="n_mappings"
    )
    out["traits_delta"] = G.cell_delta(
        expected_cells(e, per_trait=True),
        out["observed_traits"],
        TRAIT_CELL,
        observed_col="n_traits",
    )
    if e.cv_maf is not None and e.cv_ld is not None:
        ids = expected_ids(e)
        run = ["population", "nqtl", "h2", "effect", "rep"]
        out["missing_mappings"] = G.missing_ids(ids, metadata, "mapping_id").select(
            *run, "algorithm", "pca", "mapping_id"
        )
        out["missing_traits"] = G.missing_ids(
            ids.select(*run, "trait_id").distinct(), metadata, "trait_id"
        ).select(*run, "trait_id")
    out["marker_set_coverage"] = marker_set_coverage(e.groups, markers, genotypes)
    out["summary"] = summary
    out["status"] = status_of(summary, 1, True, True)
    return out
