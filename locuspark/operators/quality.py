"""Data-quality checks: each returns the violating rows with a ``check`` column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuspark.functions.ids import ID_PATTERN
from locuspark.functions.names import SPECIES
from locuspark.operators.grid import decimal_key
from locuspark.operators.performance import OUTCOMES

# Algorithms and the shape of a QTL name.
ALGORITHMS = ("inbred", "loco")
QTL_PATTERN = "^[^:]+:[0-9]+$"


def _tag(df: DataFrame, check: str) -> DataFrame:
    return df.withColumn("check", F.lit(check))


def dq_strainfile(
    groups: DataFrame, cv_maf: float | None = None, cv_ld: float | None = None
) -> DataFrame:
    """Groups with an unknown species or a parameter out of range, one row per problem."""
    problems = [
        ("species", ~F.col("species").isin(*SPECIES)),
        ("ms_maf", ~((F.col("ms_maf") > 0) & (F.col("ms_maf") <= 0.5))),
        ("ms_ld", ~((F.col("ms_ld") > 0) & (F.col("ms_ld") < 1))),
    ]
    if cv_maf is not None:
        problems.append(("cv_maf", F.lit(not 0 < cv_maf <= 0.5)))
    if cv_ld is not None:
        problems.append(("cv_ld", F.lit(not 0 < cv_ld < 1)))
    found = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in problems]))
    return groups.withColumn("check", F.explode(found))


def dq_unique(df: DataFrame, keys: Sequence[str], check: str = "unique_key") -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return _tag(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1), check
    )


def dq_unique_markers(mappings: DataFrame) -> DataFrame:
    return dq_unique(mappings, ["mapping_id", "CHROM", "POS"], "unique_marker")


def dq_p_range(mappings: DataFrame) -> DataFrame:
    p = F.col("P")
    return _tag(mappings.where(p.isNotNull() & ~((p > 0) & (p <= 1))), "p_range")


def dq_id_format(df: DataFrame, id_col: str) -> DataFrame:
    return _tag(df.where(~F.coalesce(F.col(id_col).rlike(ID_PATTERN), F.lit(False))), "id_format")


def dq_arms(df: DataFrame, algorithm: str = "algorithm", pca: str = "pca") -> DataFrame:
    known = F.coalesce(F.col(algorithm).isin(*ALGORITHMS), F.lit(False))
    return _tag(df.where(~known | F.col(pca).isNull()), "arms")


def dq_marker_counts(
    mappings: DataFrame, metadata: DataFrame, ms_metadata: DataFrame
) -> DataFrame:
    """Mappings whose recorded count differs from their rows or from their marker set."""
    rows = mappings.groupBy("mapping_id").agg(F.count(F.lit(1)).alias("n_rows"))
    sets = ms_metadata.select("marker_set_id", F.col("n_markers").alias("n_set"))
    joined = (
        metadata.select("mapping_id", "marker_set_id", "n_markers")
        .join(rows, "mapping_id", "left")
        .join(sets, "marker_set_id", "left")
    )
    found = F.array_compact(
        F.array(
            F.when(~F.col("n_markers").eqNullSafe(F.col("n_rows")), F.lit("partition_rows")),
            F.when(~F.col("n_markers").eqNullSafe(F.col("n_set")), F.lit("marker_set_size")),
        )
    )
    return joined.withColumn("check", F.explode(found)).select(
        "mapping_id", "n_markers", "n_rows", "n_set", "check"
    )


def dq_eigen_source(ms_metadata: DataFrame, lookup: DataFrame) -> DataFrame:
    """Marker sets whose stored independent-test count is not the source file's, or that have no source file."""
    source = lookup.select(
        "population", decimal_key(F.col("maf")).alias("_maf"), F.col("n_tests").alias("source_tests")
    )
    joined = (
        ms_metadata.select("population", "maf", "n_independent_tests")
        .withColumn("_maf", decimal_key(F.col("maf")))
        .join(source.withColumn("_found", F.lit(True)), ["population", "_maf"], "left")
    )
    wrong = F.col("_found").isNull() | ~F.col("n_independent_tests").eqNullSafe(F.col("source_tests"))
    return _tag(joined.where(wrong).drop("_maf", "_found"), "eigen_source")


def dq_designations(designated: DataFrame) -> DataFrame:
    known = F.coalesce(F.col("designation").isin(*OUTCOMES), F.lit(False))
    return _tag(designated.where(~known), "designation")


def dq_untested_causal(assessment: DataFrame) -> DataFrame:
    """Simulated rows without a score that nevertheless carry a significance flag."""
    return _tag(
        assessment.where(
            F.col("Simulated") & F.col("log10p").isNull() & F.col("significant").isNotNull()
        ),
        "untested_causal",
    )


def dq_causal_off_markers(causal: DataFrame, traits: DataFrame, markers: DataFrame) -> DataFrame:
    """Causal variants that are not in their trait's marker set."""
    known = markers.select("marker_set_id", F.col("marker").alias("QTL")).distinct()
    return _tag(
        causal.join(traits.select("trait_id", "marker_set_id"), "trait_id").join(
            known, ["marker_set_id", "QTL"], "left_anti"
        ),
        "off_marker",
    )


def dq_phenotypes(phenotypes: DataFrame) -> DataFrame:
    return _tag(phenotypes.where(F.col("phenotype").isNull()), "phenotype")


def dq_qtl_names(causal: DataFrame, qtl: str = "QTL") -> DataFrame:
    return _tag(causal.where(~F.coalesce(F.col(qtl).rlike(QTL_PATTERN), F.lit(False))), "qtl_name")


def dq_chromosomes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Chromosome names found in only one of two assessments."""
    left, right = a.select("CHROM").distinct(), b.select("CHROM").distinct()
    return left.exceptAll(right).withColumn("check", F.lit("only_first")).unionByName(
        right.exceptAll(left).withColumn("check", F.lit("only_second"))
    )


def dq_schema(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """Declared against actual column types; reads schemas only, no rows."""
    rows = []
    for name, (df, declared) in tables.items():
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        for f in declared.fields:
            have = actual.get(f.name)
            want = f.dataType.simpleString()
            if have != want:
                rows.append((name, f.name, want, have))
    out = spark.createDataFrame(
        rows, "table_name string, column_name string, declared string, actual string"
    )
    return _tag(out, "schema")


def dq_significant_share(analyzed: DataFrame, limit: float = 0.15) -> DataFrame:
    """Arms where more than ``limit`` of the markers are significant (a report, never a filter)."""
    n_sig = F.coalesce(F.sum("significant"), F.lit(0))
    return _tag(
        analyzed.groupBy("mapping_id", "sig_threshold_method")
        .agg((n_sig / F.count(F.lit(1))).alias("share"))
        .where(F.col("share") > limit),
        "significant_share",
    )
