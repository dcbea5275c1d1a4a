"""Look-ups over the stored tables: filters, joins and small summaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions.scores import with_position

THRESHOLD_COLUMNS = (
    "mapping_id population maf marker CHROM POS AF1 BETA SE P var_exp"
).split()


def by_population(mappings: DataFrame, population: str) -> DataFrame:
    """Partition filter; only that population's files are read."""
    return mappings.where(F.col("population") == population)


def by_mapping_id(mappings: DataFrame, mapping_id: str) -> DataFrame:
    return mappings.where(F.col("mapping_id") == mapping_id)


def by_method(
    metadata: DataFrame, population: str, algorithm: str, pca: bool | None = None
) -> DataFrame:
    out = metadata.where(
        (F.col("population") == population) & (F.col("algorithm") == algorithm)
    )
    return out if pca is None else out.where(F.col("pca") == pca)


def by_architecture(
    metadata: DataFrame,
    h2: float | None = None,
    nqtl: int | None = None,
    population: str | None = None,
    maf: float | None = None,
) -> DataFrame:
    """Any subset of the four parameters; doubles are compared exactly as stored."""
    wanted = {"h2": h2, "nqtl": nqtl, "population": population, "maf": maf}
    for name, value in wanted.items():
        if value is not None:
            metadata = metadata.where(F.col(name) == F.lit(value))
    return metadata


def all_metadata(metadata: DataFrame) -> DataFrame:
    """Every metadata row next to the number of mappings in its population."""
    counts = metadata.groupBy("population").agg(F.count(F.lit(1)).alias("n_in_population"))
    return metadata.join(counts, "population")


def mapping_data(
    mappings: DataFrame,
    metadata: DataFrame,
    markers: DataFrame,
    population: str | None = None,
    maf: float | None = None,
    h2: float | None = None,
    nqtl: int | None = None,
    algorithm: str | None = None,
) -> DataFrame:
    """Statistics with the mapping's parameters and the marker's alleles.

    Filters reach the scans: population prunes partitions, the others shrink
    metadata before the join. A filter on metadata drops unmatched rows, so the
    join is inner exactly then.
    """
    meta = metadata.select(
        "mapping_id", "marker_set_id", "maf", "nqtl", "rep", "h2", "effect", "algorithm", "pca"
    )
    meta_filters = {"maf": maf, "h2": h2, "nqtl": nqtl, "algorithm": algorithm}
    filtered = False
    for name, value in meta_filters.items():
        if value is not None:
            meta = meta.where(F.col(name) == F.lit(value))
            filtered = True
    if population is not None:
        mappings = by_population(mappings, population)
    joined = mappings.join(meta, "mapping_id", "inner" if filtered else "left")
    return joined.join(markers, ["marker_set_id", "marker"], "left")


def threshold_projection(joined: DataFrame) -> DataFrame:
    """The columns threshold analysis needs; variance explained only where present."""
    present = "var_exp" in joined.columns
    return joined.withColumn(
        "var_exp", F.col("var_exp") if present else F.lit(None).cast("double")
    ).select(*THRESHOLD_COLUMNS)


def threshold_data(
    mappings: DataFrame, metadata: DataFrame, markers: DataFrame, mapping_id: str
) -> DataFrame:
    return threshold_projection(
        mapping_data(by_mapping_id(mappings, mapping_id), metadata, markers)
    )


def threshold_data_bulk(
    mappings: DataFrame, metadata: DataFrame, markers: DataFrame, ids: DataFrame
) -> DataFrame:
    """The same for a table of ids: a semi-join, so the list may be of any length."""
    chosen = mappings.join(ids.select("mapping_id").distinct(), "mapping_id", "left_semi")
    return threshold_projection(mapping_data(chosen, metadata, markers))


def mapping_direct(mappings: DataFrame, metadata: DataFrame, mapping_id: str) -> DataFrame:
    """One partition with positions taken from the marker name instead of a join."""
    rows = with_position(by_mapping_id(mappings, mapping_id))
    maf = metadata.where(F.col("mapping_id") == mapping_id).select("mapping_id", "maf")
    return rows.join(maf, "mapping_id", "left").withColumn(
        "var_exp", F.lit(None).cast("double")
    ).select(*THRESHOLD_COLUMNS)


def simulation_summary(metadata: DataFrame, population: str | None = None) -> DataFrame:
    if population is not None:
        metadata = metadata.where(F.col("population") == population)
    return metadata.groupBy("population", "maf", "nqtl", "h2", "algorithm", "pca").agg(
        F.countDistinct("rep").alias("n_reps"),
        F.countDistinct("mapping_id").alias("n_mappings"),
    )


def architecture_summary(metadata: DataFrame) -> DataFrame:
    """Per architecture: algorithms, replicates, mappings and the algorithm names.

    Names are sorted; there are only a few, so the set stays small.
    """
    return metadata.groupBy("population", "maf", "h2", "nqtl").agg(
        F.countDistinct("algorithm").alias("n_algorithms"),
        F.countDistinct("rep").alias("n_reps"),
        F.count(F.lit(1)).alias("n_mappings"),
        F.array_join(F.sort_array(F.collect_set("algorithm")), ", ").alias("algorithms"),
    )


def marker_count(mappings: DataFrame) -> DataFrame:
    return mappings.groupBy("mapping_id").agg(F.countDistinct("marker").alias("n_markers"))


def chrom_extent(markers: DataFrame) -> DataFrame:
    return markers.groupBy("marker_set_id", "CHROM").agg(
        F.count(F.lit(1)).alias("n_markers"),
        F.min("POS").alias("min_pos"),
        F.max("POS").alias("max_pos"),
    )


def conform(df: DataFrame, schema) -> DataFrame:
    """Cast declared columns to their declared types; other columns stay as they are."""
    declared = {f.name: f.dataType for f in schema.fields}
    return df.select(
        *[F.col(c).cast(declared[c]).alias(c) if c in declared else F.col(c) for c in df.columns]
    )


def single_trait(df: DataFrame) -> DataFrame:
    """The trait label, and whether there was more than one (then the smallest)."""
    if "trait" not in df.columns:
        return df.limit(0).agg(
            F.lit(None).cast("string").alias("trait"), F.lit(False).alias("several")
        )
    return df.agg(
        F.min("trait").alias("trait"), (F.min("trait") != F.max("trait")).alias("several")
    )


def select_or_null(df: DataFrame, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """Fixed column order; a missing column is added as a typed null."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns
        ]
    )
