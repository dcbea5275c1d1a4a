"""Parameter grids: expected cells, arms and their comparison with what exists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _choices(values: Sequence, kind: str) -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def parameter_grid(
    groups: DataFrame,
    nqtl: Sequence[int],
    effect: Sequence[str],
    h2: Sequence[float],
    reps: int,
    algorithm: Sequence[str] | None = None,
    pca: Sequence[bool] | None = None,
) -> DataFrame:
    """Every combination for every group: each value list is exploded in place, map-side."""
    out = groups
    lists = [("nqtl", nqtl, "int"), ("effect", effect, "string"), ("h2", h2, "double")]
    for name, values, kind in lists:
        out = out.withColumn(name, F.explode(_choices(values, kind)))
    out = out.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(reps))))
    if algorithm is not None:
        out = out.withColumn("algorithm", F.explode(_choices(algorithm, "string")))
    if pca is not None:
        out = out.withColumn("pca", F.explode(_choices(pca, "boolean")))
    return out


def fan_out(
    df: DataFrame,
    modes: Sequence[str] = ("inbred", "loco"),
    types: Sequence[str] = ("pca", "nopca"),
    thresholds: Sequence[str] = ("BF", "EIGEN"),
) -> DataFrame:
    """Each row once per mode, type and threshold."""
    for name, values in (("mode", modes), ("type", types), ("threshold", thresholds)):
        df = df.withColumn(name, F.explode(_choices(values, "string")))
    return df


def decimal_key(c: Column) -> Column:
    """Fixed-decimal text, so that doubles match as join keys."""
    return F.format_string("%.10f", c.cast("double"))


def cell_delta(
    expected: DataFrame,
    observed: DataFrame,
    keys: Sequence[str],
    expected_col: str = "expected",
    observed_col: str = "observed",
) -> DataFrame:
    """Expected against observed counts on the cell key, both sides kept."""
    doubles = {f.name for f in expected.schema.fields if f.dataType.simpleString() == "double"}

    def keyed(df: DataFrame, value: str, name: str) -> DataFrame:
        key = [(decimal_key(F.col(k)) if k in doubles else F.col(k)).alias(f"_k_{k}") for k in keys]
        return df.select(*key, *[F.col(k).alias(f"{name}_{k}") for k in keys], F.col(value).alias(name))

    joined = keyed(expected, expected_col, "_e").join(
        keyed(observed, observed_col, "_o"), [f"_k_{k}" for k in keys], "full"
    )
    want = F.coalesce("_e", F.lit(0)).cast("long")
    have = F.coalesce("_o", F.lit(0)).cast("long")
    return joined.select(
        *[F.coalesce(f"_e_{k}", f"_o_{k}").alias(k) for k in keys],
        want.alias("expected"),
        have.alias("observed"),
        F.greatest(want - have, F.lit(0)).alias("missing"),
        F.when(want > 0, have / want).alias("pct_complete"),
    )


def missing_ids(expected: DataFrame, observed: DataFrame, id_col: str) -> DataFrame:
    return expected.join(observed.select(id_col).distinct(), id_col, "left_anti")


def hydrate_groups(strainfile: DataFrame, ms_metadata: DataFrame) -> DataFrame:
    """Strainfile groups with what the database knows about their marker set.

    The strainfile's ms_ld wins; a group without a marker set is flagged.
    """
    known = ms_metadata.select(
        "population",
        decimal_key(F.col("maf")).alias("_maf"),
        "species",
        "vcf_release_id",
        F.col("ms_ld").alias("_db_ms_ld"),
        "marker_set_id",
        "n_markers",
        "n_independent_tests",
    )
    clash = ["species", "vcf_release_id", "marker_set_id", "n_markers", "n_independent_tests"]
    left = strainfile.drop(*[c for c in clash if c in strainfile.columns])
    own_ld = F.col("ms_ld") if "ms_ld" in left.columns else F.lit(None).cast("double")
    return (
        left.withColumns({"_maf": decimal_key(F.col("maf")), "_own_ms_ld": own_ld})
        .join(known, ["population", "_maf"], "left")
        .withColumn("ms_ld", F.coalesce("_own_ms_ld", "_db_ms_ld"))
        .withColumn("marker_set_metadata_present", F.col("marker_set_id").isNotNull())
        .drop("_maf", "_own_ms_ld", "_db_ms_ld")
    )


def bundle(markers: DataFrame, eigen: DataFrame, groups: DataFrame) -> DataFrame:
    """Marker list, independent tests and strainfile row joined one-to-one on (group, maf)."""
    sides = []
    for df in (markers, eigen, groups):
        keyed = df.withColumn("_key", decimal_key(F.col("maf")))
        sides.append(require_unique(keyed, ["group", "_key"]))
    first, second, third = sides
    return (
        first.join(second.drop("maf"), ["group", "_key"])
        .join(third.drop("maf"), ["group", "_key"])
        .drop("_key")
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; fails the job where a key occurs twice."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    checked = F.when(F.col("_copies") == 1, F.lit(1)).otherwise(
        F.raise_error(F.concat(F.lit("duplicate key: "), F.concat_ws("|", *keys)))
    )
    return (
        df.join(counts, list(keys))
        .withColumn("_copies", checked)
        .where(F.col("_copies") == 1)
        .drop("_copies")
    )


def effective_cv_maf(groups: DataFrame, cv_maf: float | None = None) -> DataFrame:
    """The causal pool's MAF: the global setting, else the group's own."""
    value = F.coalesce(F.lit(cv_maf).cast("double"), F.col("ms_maf"))
    return groups.withColumns(
        {"cv_maf_effective": value, "cv_maf_above": value > F.col("ms_maf")}
    )


REPLAY_KEY = ("species", "group", "nqtl", "effect", "h2", "rep")


def replay_filter(grid: DataFrame, manifest: DataFrame) -> DataFrame:
    """Grid rows whose slot is in the manifest.

    nqtl is compared as text, h2 as a 32-bit float on both sides; maf is not
    part of the key.
    """

    def key(df: DataFrame) -> list[Column]:
        return [
            F.col("species"),
            F.col("group"),
            F.col("nqtl").cast("string").alias("_nqtl"),
            F.col("effect"),
            F.col("h2").cast("float").alias("_h2"),
            F.col("rep").cast("int").alias("_rep"),
        ]

    slots = manifest.select(*key(manifest)).distinct()
    tagged = grid.select("*", *key(grid)[2:3], *key(grid)[4:])
    on = ["species", "group", "_nqtl", "effect", "_h2", "_rep"]
    return tagged.join(slots, on, "left_semi").select(*grid.columns)


def short_cells(metadata: DataFrame, expected_reps: int) -> DataFrame:
    """Cells whose distinct replicate count differs from the expected one, either way."""
    return (
        metadata.groupBy("population", "maf", "nqtl", "effect", "h2", "algorithm", "pca")
        .agg(F.countDistinct("rep").alias("n_reps"))
        .where(F.col("n_reps") != expected_reps)
        .withColumn("expected_reps", F.lit(expected_reps))
    )


def observed_cells(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("population", "nqtl", "h2", "effect", "algorithm", "pca").agg(
        F.count(F.lit(1)).alias("n_mappings"),
        F.countDistinct("trait_id").alias("n_distinct_traits"),
        F.countDistinct("rep").alias("n_distinct_rep"),
    )


def observed_traits(cells: DataFrame) -> DataFrame:
    return cells.groupBy("population", "nqtl", "h2", "effect").agg(
        F.max("n_distinct_traits").alias("n_traits"),
        F.max("n_distinct_rep").alias("n_distinct_rep"),
    )


def observed_grid(cells: DataFrame) -> DataFrame:
    """One row: the sorted values of every dimension and the most replicates seen."""

    def values(name: str) -> Column:
        return F.array_join(F.sort_array(F.collect_set(name)).cast("array<string>"), ",").alias(name)

    return cells.agg(
        *[values(c) for c in ("population", "nqtl", "h2", "effect", "algorithm", "pca")],
        F.max("n_distinct_rep").alias("reps_max"),
    )


def top_gaps(delta: DataFrame, k: int = 10) -> DataFrame:
    """The k cells with most missing; the cell key breaks ties."""
    keys = [c for c in delta.columns if c not in ("expected", "observed", "missing", "pct_complete")]
    return delta.where(F.col("missing") > 0).orderBy(F.desc("missing"), *keys).limit(k)


def failures_by_exit(failures: DataFrame) -> DataFrame:
    return failures.groupBy("exit_code").agg(F.count(F.lit(1)).alias("n"))


def delete_slots(
    table: DataFrame, manifest_ids: DataFrame, id_col: str
) -> DataFrame:
    """Rows of ``table`` left after removing every replayed slot; running it twice changes nothing."""
    return table.join(manifest_ids.select(id_col).distinct(), id_col, "left_anti")


def slot_ids(
    manifest: DataFrame, ms_metadata: DataFrame, cv_maf: float | None, cv_ld: float
) -> DataFrame:
    """trait_id and the four mapping_ids of every manifest slot."""
    from locuspark.functions.ids import with_ids

    known = ms_metadata.select(
        F.col("population").alias("group"),
        decimal_key(F.col("maf")).alias("_maf"),
        "vcf_release_id",
        "ms_ld",
    )
    slots = (
        manifest.select("species", "group", "maf", "nqtl", "effect", "h2", "rep")
        .distinct()
        .withColumn("_maf", decimal_key(F.col("maf")))
        .join(known, ["group", "_maf"], "left")
        .drop("_maf")
    )
    arms = parameter_arms(slots)
    return with_ids(
        arms.withColumns(
            {
                "population": F.col("group"),
                "cv_maf_effective": F.coalesce(F.lit(cv_maf).cast("double"), F.col("maf")),
                "cv_ld": F.lit(cv_ld).cast("double"),
            }
        )
    )


def parameter_arms(df: DataFrame) -> DataFrame:
    """Each row once per mapping arm: inbred and loco, with and without components."""
    return df.withColumn(
        "algorithm", F.explode(_choices(["inbred", "loco"], "string"))
    ).withColumn("pca", F.explode(_choices([True, False], "boolean")))
