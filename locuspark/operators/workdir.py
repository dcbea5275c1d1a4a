"""Work-directory usage: task, size and file logs joined and summarised."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.session import stage

# Process phases and the processes reported by panel size.
PHASES = {
    "1_PrepMarkers": (
        "LOCAL_GET_CONTIG_INFO",
        "BCFTOOLS_EXTRACT_STRAINS",
        "BCFTOOLS_RENAME_CHROMS",
        "PLINK_RECODE_MS_VCF",
        "PLINK_RECODE_CV_VCF",
        "BCFTOOLS_CREATE_GENOTYPE_MATRIX",
        "R_FIND_GENOTYPE_MATRIX_EIGEN",
        "LOCAL_COMPILE_EIGENS",
    ),
    "2_SimPheno": (
        "PYTHON_SIMULATE_EFFECTS_GLOBAL",
        "GCTA_SIMULATE_PHENOTYPES",
        "PLINK_UPDATE_BY_H2",
    ),
    "3_GWAS": ("GCTA_MAKE_GRM", "GCTA_PERFORM_GWA"),
    "4_DB": (
        "DB_MIGRATION_WRITE_MARKER_SET",
        "DB_MIGRATION_WRITE_GENOTYPE_MATRIX",
        "DB_MIGRATION_WRITE_TRAIT_DATA",
        "DB_MIGRATION_WRITE_GWA_TO_DB",
        "DB_MIGRATION_AGGREGATE_METADATA",
        "DB_MIGRATION_ANALYZE_QTL",
        "DB_MIGRATION_ASSESS_SIMS",
    ),
}
UNKNOWN_PHASE = "5_Unknown"
PANEL_PROCESSES = (
    "PLINK_RECODE_MS_VCF",
    "PLINK_RECODE_CV_VCF",
    "BCFTOOLS_EXTRACT_STRAINS",
    "BCFTOOLS_RENAME_CHROMS",
    "BCFTOOLS_CREATE_GENOTYPE_MATRIX",
    "R_FIND_GENOTYPE_MATRIX_EIGEN",
    "GCTA_MAKE_GRM",
    "GCTA_PERFORM_GWA",
)
# Parts into which a round of the rank search cuts every bracket.
PARTS = 4096


def join_workdir(tasks: DataFrame, usage: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per directory that holds files: process, size, file counts, largest file.

    The inventory is aggregated before any join. Symlinks count as files but not
    towards the largest file; ties go to the first name.
    """
    real = F.col("kind") != "l"
    largest = F.min(
        F.when(real & (F.col("bytes") > 0), F.struct(-F.col("bytes"), F.col("file_name")))
    )
    files = inventory.groupBy("work_dir").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count(F.when(~real, 1)).alias("n_symlinks"),
        F.count(F.when(real, 1)).alias("n_real_files"),
        largest.alias("_largest"),
    )
    joined = files.join(tasks, "work_dir", "left").join(usage, "work_dir", "left")
    name = F.coalesce(F.col("_largest.file_name"), F.lit(""))
    tag = F.coalesce("tag", F.lit(""))

    def panel(text):
        # Digits right after the last ".n".
        found = F.regexp_extract(F.regexp_replace(text, r"^.*\.n", ""), "^([0-9]+)", 1)
        return F.when(text.rlike(r"\.n") & (found != ""), found)

    return joined.select(
        F.col("work_dir").alias("work_hash"),
        F.coalesce("process", F.lit("UNKNOWN")).alias("process"),
        tag.alias("tag"),
        F.coalesce(panel(tag), panel(name), F.lit("NA")).alias("panel_size"),
        F.coalesce("total_bytes", F.lit(0.0)).alias("total_bytes"),
        "n_files",
        "n_symlinks",
        "n_real_files",
        F.coalesce(-F.col("_largest.col1"), F.lit(0.0)).alias("largest_file_bytes"),
        name.alias("largest_file_name"),
    )


def derive_workdir_fields(metrics: DataFrame) -> DataFrame:
    """Clean process names, numeric panel size, shares, gigabytes, extension and phase."""
    process = F.trim(F.regexp_replace("process", "^nf-", ""))
    extension = F.regexp_extract("largest_file_name", r"\.[^./]+$", 0)
    phase = F.lit(UNKNOWN_PHASE)
    for label, names in PHASES.items():
        phase = F.when(F.col("process").isin(*names), label).otherwise(phase)
    return (
        metrics.withColumn(
            "process", F.when(process != "", process).otherwise(F.lit("UNKNOWN"))
        )
        .withColumns(
            {
                "panel_size_n": F.col("panel_size").try_cast("int"),
                "symlink_frac": F.col("n_symlinks") / F.greatest(F.col("n_files"), F.lit(1)),
                "total_gb": F.col("total_bytes") / 1e9,
                "largest_ext": F.when(F.coalesce(extension, F.lit("")) != "", extension).otherwise(
                    F.lit("(none)")
                ),
                "phase": phase,
            }
        )
    )


def _part(value: Column, low: Column, high: Column, scaled: bool) -> Column:
    """The part of a bracket a value falls into, in the order of the values.

    The first round goes by sign and binary exponent, so that values of any
    scale are told apart; later ones cut the bracket into equal widths.
    """
    if not scaled:
        size = F.floor(F.log2(F.abs(value))).cast("long") + 1100
        return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("long"))
    # Halves keep the width finite between the largest numbers of both signs.
    share = (value / 2 - low / 2) / (high / 2 - low / 2)
    return F.when(low == high, F.lit(0).cast("long")).otherwise(F.least(F.floor(share * PARTS), F.lit(PARTS - 1).cast("long")))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], wanted: dict[str, Sequence[float]]
) -> DataFrame:
    """Interpolated quantiles of several columns per group: keys and ``<column>_q<i>``.

    A search for ranks, digit by digit: equal values are merged, and every rank
    next to a wanted quantile has a bracket that starts as the whole column. A
    round counts the values of each part of every bracket and keeps the part that
    holds the rank, shrunk to its smallest and largest value, until all brackets
    are single values. What a round shuffles is counts, at most ``PARTS`` for a
    rank and task; no group is sorted or gathered, whatever its size. Nulls and
    NaN do not count; a group without values has null quantiles.
    """
    merged: DataFrame | None = None
    for column in wanted:
        value = F.col(column).cast("double")
        one = df.where(value.isNotNull() & ~F.isnan(value)).groupBy(*keys, F.lit(column).alias("_c"), value.alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
        merged = one if merged is None else merged.unionByName(one)
    merged = stage(merged, "merged-values")
    whole = merged.groupBy(*keys, "_c").agg(F.sum("_k").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    ranks = None
    for column, quantiles in wanted.items():
        at = [F.lit(float(q)) * (F.col("_n") - 1) for q in quantiles]
        own = F.array_distinct(F.array(*[end(r).cast("long") for r in at for end in (F.floor, F.ceil)]))
        ranks = F.when(F.col("_c") == column, own) if ranks is None else ranks.when(F.col("_c") == column, own)
    open_ = whole.select(*keys, "_c", F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_below"), "_lo", "_hi")
    open_ = stage(open_, "rank-brackets")
    found = open_.where("_lo = _hi")
    scaled = False
    while not (open_ := open_.where("_lo < _hi")).isEmpty():
        meet = [merged[k].eqNullSafe(open_[k]) for k in (*keys, "_c")]
        rows = merged.join(open_.select(*keys, "_c", "_rank", "_below", "_lo", "_hi"), _all(meet) & merged["_v"].between(open_["_lo"], open_["_hi"]))
        rows = rows.select(*[open_[k] for k in (*keys, "_c")], "_rank", "_below", "_v", "_k", _part(F.col("_v"), F.col("_lo"), F.col("_hi"), scaled).alias("_p"))
        target = [*keys, "_c", "_rank", "_below"]
        parts = rows.groupBy(*target, "_p").agg(F.sum("_k").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = Window.partitionBy(*target).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
        placed = parts.withColumn("_end", F.col("_below") + F.sum("_n").over(upto))
        held = placed.where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_n")))
        open_ = stage(held.select(*keys, "_c", "_rank", (F.col("_end") - F.col("_n")).alias("_below"), "_lo", "_hi"), "rank-brackets")
        found = found.unionByName(open_.where("_lo = _hi"))
        scaled = True
    values = whole.join(found.select(*[F.col(k).alias(f"_f{k}") for k in (*keys, "_c")], "_rank", F.col("_lo").alias("_x")), _all([F.col(k).eqNullSafe(F.col(f"_f{k}")) for k in (*keys, "_c")]))
    out = []
    for column, quantiles in wanted.items():
        for i, q in enumerate(quantiles):
            rank = F.lit(float(q)) * (F.col("_n") - 1)
            low, high = [F.max(F.when((F.col("_c") == column) & (F.col("_rank") == end(rank)), F.col("_x"))) for end in (F.floor, F.ceil)]
            rest = F.max(F.when(F.col("_c") == column, rank - F.floor(rank)))
            out.append((low + (high - low) * rest).alias(f"{column}_q{i}"))
    return values.groupBy(*keys).agg(*out)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The most frequent value per group; the smallest one among equals."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct(-F.col("_n"), F.col(value)))
    return counts.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, F.col(f"_best.{value}").alias(name)
    )


def process_stats(derived: DataFrame) -> DataFrame:
    """Sizes per process and phase."""
    keys = ["process", "phase"]
    derived = stage(derived.select(*keys, "total_gb", "symlink_frac", "largest_ext"), "derived")
    totals = derived.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.avg("total_gb").alias("mean_gb"),
        F.sum("total_gb").alias("total_gb_sum"),
    )
    ranks = exact_quantiles(derived, keys, {"total_gb": (0.5, 0.95), "symlink_frac": (0.5,)})
    return (
        totals.join(ranks, keys)
        .join(most_frequent(derived, keys, "largest_ext", "top_ext"), keys)
        .withColumnsRenamed(
            {
                "total_gb_q0": "median_gb",
                "total_gb_q1": "p95_gb",
                "symlink_frac_q0": "median_symlink_f",
            }
        )
    )


def panel_stats(derived: DataFrame, processes: Sequence[str] = PANEL_PROCESSES) -> DataFrame:
    """Sizes per process and panel size, for the reported processes."""
    keys = ["process", "panel_size_n"]
    rows = derived.where(F.col("process").isin(*processes) & F.col("panel_size_n").isNotNull())
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.avg("total_gb").alias("mean_gb"),
        F.sum("total_gb").alias("total_gb"),
    )
    sizes = exact_quantiles(rows, keys, {"total_gb": (0.5, 0.95)})
    return totals.join(sizes, keys).withColumnsRenamed(
        {"total_gb_q0": "median_gb", "total_gb_q1": "p95_gb"}
    )


def top_processes(stats: DataFrame, k: int = 10, total: str = "total_gb_sum") -> DataFrame:
    """The k largest processes, ties at the border kept.

    The k-th value is a scalar subquery (a bounded top-k) that the scan is filtered by.
    The totals are written first: sums of doubles differ from run to run in their last
    digits, and a border taken from another run may miss its own row.
    """
    stats = stage(stats, "process-totals")
    border = stats.select(total).orderBy(F.desc(total)).limit(k).agg(F.min(total))
    return stats.where(F.col(total) >= border.scalar())


def lump_other(df: DataFrame, column: str, k: int = 10, n: str = "n") -> DataFrame:
    """Values outside the k most frequent become ``other``."""
    counts = df.groupBy(column).agg(F.sum(n).alias("_n"))
    top = counts.orderBy(F.desc("_n"), column).limit(k).select(column, F.lit(True).alias("_top"))
    return (
        df.join(top, column, "left")
        .withColumn(column, F.when(F.col("_top"), F.col(column)).otherwise(F.lit("other")))
        .drop("_top")
        .select(*df.columns)
    )
