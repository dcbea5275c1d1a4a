"""The stored database: table readers, views and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from locuspark import schemas
from locuspark.operators.sets import union_all
from locuspark.sources.footers import footers, from_path

# Folder of every table below the database root.
LAYOUT = {
    "markers": "markers/marker_sets",
    "genotypes": "markers/genotypes",
    "marker_set_metadata": "markers/metadata",
    "traits": "traits/metadata",
    "causal_variants": "traits/causal_variants",
    "phenotypes": "traits/phenotypes",
    "causal_genotypes": "traits/causal_genotypes",
    "mappings": "mappings",
    "metadata": "mapping_metadata",
    "qtl_regions": "analysis/qtl_regions",
    "analysis_summary": "analysis/summary",
    "analysis_metadata": "analysis/runs",
}
VIEWS = ("markers", "mappings", "metadata", "marker_set_metadata")
PARTITIONS = {
    "markers": ("marker_set_id",),
    "genotypes": ("marker_set_id",),
    "traits": ("trait_id",),
    "causal_variants": ("trait_id",),
    "phenotypes": ("trait_id",),
    "causal_genotypes": ("trait_id",),
    "marker_set_metadata": ("marker_set_id",),
    "mappings": ("population", "mapping_id"),
    "metadata": ("population", "mapping_id"),
    "qtl_regions": ("population", "algorithm"),
    "analysis_summary": ("population", "algorithm"),
}


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{LAYOUT[table]}"


def stored_schema(table: str) -> T.StructType:
    """The declared schema plus the columns that live in the path."""
    declared = schemas.TABLES[table]
    names = set(declared.names)
    path_only = [c for c in PARTITIONS.get(table, ()) if c not in names]
    return T.StructType(
        declared.fields + [T.StructField(c, T.StringType(), True) for c in path_only]
    )


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """A stored table, or None when it was never written."""
    try:
        return spark.read.schema(stored_schema(table)).parquet(table_path(base, table))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_or_empty(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A stored table, or an empty frame of its declared schema."""
    found = read_table(spark, base, table)
    return spark.createDataFrame([], stored_schema(table)) if found is None else found


def read_by_key(
    spark: SparkSession, base: str, table: str, key: str, value: str, required: bool = True
) -> DataFrame | None:
    """Rows of one key; a missing key fails, or gives None when not required."""
    rows = read_or_empty(spark, base, table).where(F.col(key) == value)
    if rows.isEmpty():
        if required:
            raise LookupError(f"{table}: nothing stored for {key} = {value}")
        return None
    return rows


def open_db(spark: SparkSession, base: str) -> list[str]:
    """Register a view per table that exists; returns their names. No table at all is an error."""
    made = []
    for name in VIEWS:
        df = read_table(spark, base, name)
        if df is not None:
            df.createOrReplaceTempView(name)
            made.append(name)
    if not made:
        raise FileNotFoundError(f"no database at {base}")
    return made


def empty_mappings(expected: DataFrame, mappings: DataFrame) -> DataFrame:
    """Expected mappings without a single stored row in ``mappings``."""
    present = mappings.select("mapping_id").distinct()
    return expected.join(present, "mapping_id", "left_anti")


def empty_partitions(spark: SparkSession, base: str, expected: DataFrame) -> DataFrame:
    """mapping_id, n_files, n_unreadable of expected mappings without a row that can be read.

    File footers tell; no row is read. A mapping whose files are all unreadable
    or empty counts as empty, as does one without files.
    """
    files = footers(spark, table_path(base, "mappings")).withColumn("mapping_id", from_path("mapping_id"))
    found = files.groupBy("mapping_id").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count("problem").alias("n_unreadable"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("_rows"),
    )
    joined = expected.join(found, "mapping_id", "left").where(F.coalesce("_rows", F.lit(0)) == 0)
    return joined.select("mapping_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_files", "n_unreadable")])


def read_tolerant(spark: SparkSession, base: str) -> DataFrame:
    """Mappings with unreadable files skipped instead of failing the scan."""
    return (
        spark.read.option("ignoreCorruptFiles", "true")
        .schema(stored_schema("mappings"))
        .parquet(table_path(base, "mappings"))
    )


def db_stats(spark: SparkSession, base: str) -> DataFrame:
    """One row of database statistics."""
    sets = read_or_empty(spark, base, "marker_set_metadata")
    mappings = read_or_empty(spark, base, "mappings")
    metadata = read_or_empty(spark, base, "metadata")
    markers = read_or_empty(spark, base, "markers")
    counted = markers.agg(F.countDistinct("marker_set_id").alias("n_marker_sets"))
    eigen = sets.agg(F.count("n_independent_tests").alias("n_marker_sets_with_eigen"))
    runs = metadata.agg(
        F.countDistinct("population").alias("n_populations"),
        F.countDistinct("mapping_id").alias("n_mappings"),
    )
    parts = mappings.agg(F.countDistinct("mapping_id").alias("n_partitions"))
    found = [t for t in ("markers", "mappings", "metadata", "marker_set_metadata") if read_table(spark, base, t) is not None]
    if not found:
        raise FileNotFoundError(f"no database at {base}")
    files = union_all(footers(spark, table_path(base, t)) for t in found)
    size = files.agg(
        F.bround(F.sum("bytes") / F.lit(1024.0 * 1024.0), 2).alias("total_size_mb"),
        F.count("problem").alias("n_unreadable_files"),
    )
    # Five one-row aggregates, joined on a constant.
    out = counted.withColumn("_one", F.lit(1))
    for part in (eigen, runs, parts, size):
        out = out.join(part.withColumn("_one", F.lit(1)), "_one")
    return out.drop("_one")


def result_stats(spark: SparkSession, base: str) -> DataFrame:
    """Files, regions, summary rows and unreadable files of the analysis results, from file footers."""
    kinds = ("qtl_regions", "analysis_summary")
    files = union_all(footers(spark, table_path(base, t)).withColumn("kind", F.lit(t)) for t in kinds)
    own = {t: F.col("kind") == t for t in kinds}
    rows = {t: F.coalesce(F.sum(F.when(own[t], F.col("n_rows"))), F.lit(0)) for t in kinds}
    return files.agg(
        rows["qtl_regions"].alias("n_regions"),
        rows["analysis_summary"].alias("n_summary_rows"),
        F.count(F.when(own["qtl_regions"], 1)).alias("n_region_files"),
        F.count("problem").alias("n_unreadable_files"),
    )
