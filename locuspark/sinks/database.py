"""Partitioned table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.operators.queries import conform
from locuspark.operators.sets import dedup_first
from locuspark.schemas import TABLES
from locuspark.sources.catalog import (
    LAYOUT,
    PARTITIONS,
    read_table,
    stored_schema,
    table_path,
)

# Row order inside the files, for tight column statistics.
CLUSTERING = {
    "mappings": ("marker",),
    "genotypes": ("CHROM", "POS"),
    "markers": ("CHROM", "POS"),
}


def write_table(df: DataFrame, base: str, table: str, append: bool = False) -> None:
    """Write rows with their declared types; only partitions present in ``df`` are replaced.

    The rebalance step lets AQE split a hot partition over several files and
    merge small ones; the sort is local to a task. Rewriting the same input gives the same
    table, so a retried job is harmless.
    """
    keys = list(PARTITIONS.get(table, ()))
    declared = [f.name for f in stored_schema(table).fields]
    out = conform(df, TABLES[table]).select(*[c for c in declared if c in df.columns])
    if keys:
        out = out.hint("rebalance", *keys)
    order = [*keys, *CLUSTERING.get(table, ())]
    if order:
        out = out.sortWithinPartitions(*order)
    writer = out.write.mode("append" if append else "overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(table_path(base, table))


MAPPING_KEY = ("population", "mapping_id", "marker")


def _one_per_marker(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """One row per marker of a mapping: the first by ``order``, then by its values."""
    columns = [c for c in df.columns if c in {*MAPPING_KEY, *TABLES["mappings"].names}]
    values = [c for c in columns if c not in MAPPING_KEY]
    return dedup_first(df, MAPPING_KEY, [*order, *values]).select(*columns)


def write_mappings(df: DataFrame, base: str, order: Sequence[Column | str] = ()) -> None:
    """One Hive partition per (population, mapping_id); repeated markers are stored once.

    A mapping that is written replaces the stored one.
    """
    write_table(_one_per_marker(df, order), base, "mappings")


def write_sidecars(df: DataFrame, base: str) -> None:
    """One metadata row per mapping, replaced with its mapping."""
    write_table(df, base, "metadata")


def _absent_only(df: DataFrame, base: str, table: str, key: str) -> DataFrame:
    stored = read_table(df.sparkSession, base, table)
    if stored is None:
        return df
    return df.join(stored.select(key).distinct(), key, "left_anti")


def write_marker_sets(
    markers: DataFrame, metadata: DataFrame, base: str, overwrite: bool = True
) -> None:
    """Distinct markers and one metadata row per set; existing sets stay unless overwritten."""
    rows = markers.select(*TABLES["markers"].names).distinct()
    if not overwrite:
        rows = _absent_only(rows, base, "markers", "marker_set_id")
        metadata = _absent_only(metadata, base, "marker_set_metadata", "marker_set_id")
    write_table(rows, base, "markers")
    write_table(metadata, base, "marker_set_metadata")


def write_genotypes(df: DataFrame, base: str) -> None:
    write_table(df, base, "genotypes")


def write_traits(
    traits: DataFrame,
    causal: DataFrame,
    phenotypes: DataFrame,
    causal_genotypes: DataFrame,
    base: str,
) -> None:
    """The four tables of a trait, each partitioned by it."""
    write_table(traits, base, "traits")
    write_table(causal, base, "causal_variants")
    write_table(phenotypes, base, "phenotypes")
    write_table(causal_genotypes, base, "causal_genotypes")


def write_regions(df: DataFrame, base: str) -> bool:
    return _write_unless_empty(df, base, "qtl_regions")


def write_summary(df: DataFrame, base: str) -> bool:
    return _write_unless_empty(df, base, "analysis_summary")


def write_run(df: DataFrame, base: str) -> bool:
    return _write_unless_empty(df, base, "analysis_metadata", append=True)


def _write_unless_empty(df: DataFrame, base: str, table: str, append: bool = False) -> bool:
    """Nothing is written for empty input."""
    if df.isEmpty():
        return False
    write_table(df, base, table, append)
    return True


def run_metadata(
    summary: DataFrame, run_id: str, alpha: float, ci_size: int, snp_grouping: int
) -> DataFrame:
    """One row per run: parameters, populations, mappings and peaks per threshold method."""

    def peaks(method: str):
        return F.coalesce(
            F.sum(F.when(F.col("threshold_method") == method, F.col("n_qtl"))), F.lit(0)
        ).cast("int")

    return summary.agg(
        F.lit(run_id).alias("run_id"),
        F.lit(float(alpha)).alias("alpha"),
        F.lit(ci_size).alias("ci_size"),
        F.lit(snp_grouping).alias("snp_grouping"),
        F.countDistinct("population").cast("int").alias("n_populations"),
        F.countDistinct("mapping_id").cast("int").alias("n_mappings"),
        peaks("BF").alias("n_qtl_bf"),
        peaks("EIGEN").alias("n_qtl_eigen"),
    )


def init_database(spark: SparkSession, base: str) -> list[str]:
    """Create every missing table as an empty one; existing tables are left alone."""
    made = []
    for table in LAYOUT:
        if read_table(spark, base, table) is None:
            empty = spark.createDataFrame([], stored_schema(table))
            empty.write.mode("append").parquet(table_path(base, table))
            made.append(table)
    return made


def build_metadata(
    sidecars: DataFrame, mappings: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metadata, orphans, stats) from all sidecars and the stored mapping ids.

    A mapping without a sidecar is an orphan. Data without any sidecar at all is
    reported as fatal in the stats row.
    """
    data = mappings.groupBy("mapping_id").agg(F.count(F.lit(1)).alias("n_rows"))
    orphans = data.join(sidecars.select("mapping_id").distinct(), "mapping_id", "left_anti")
    one = F.lit(1).alias("_one")
    stats = (
        sidecars.agg(
            F.count(F.lit(1)).alias("n_sidecars"),
            F.countDistinct("mapping_id").alias("n_distinct_ids"),
        )
        .select("*", one)
        .join(data.agg(F.count(F.lit(1)).alias("n_data")).select("*", one), "_one")
        .join(orphans.agg(F.count(F.lit(1)).alias("n_orphans")).select("*", one), "_one")
        .drop("_one")
        .withColumn("fatal", (F.col("n_sidecars") == 0) & (F.col("n_data") > 0))
    )
    return sidecars.dropDuplicates(["mapping_id"]), orphans, stats
