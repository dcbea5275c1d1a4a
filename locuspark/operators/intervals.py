"""Significance flags, peaks and confidence intervals over all mappings at once.

``ARM`` identifies one analysis: a mapping under one threshold method.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuspark.functions.scores import safe_log10p, with_position
from locuspark.operators.blocks import POSITION_BLOCK, block_of, position_index
from locuspark.session import stage

ARM = ("mapping_id", "sig_threshold_method")

# Marker indices under one join key when an index is looked up.
INDEX_BUCKET = 1024


def ensure_position(df: DataFrame) -> DataFrame:
    return df if "CHROM" in df.columns and "POS" in df.columns else with_position(df)


def flag_significant(mappings: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Every mapping row once per threshold, with log10p and a 0/1 flag.

    The flag is inclusive (``>=``) and unknown where the p-value is.
    """
    return (
        mappings.join(thresholds, "mapping_id")
        .withColumn("log10p", safe_log10p(F.col("P")))
        .withColumn(
            "significant", (F.col("log10p") >= F.col("sig_threshold_value")).cast("int")
        )
    )


def assign_peaks(
    significant: DataFrame,
    snp_grouping: int = 1000,
    keys: tuple[str, ...] = ARM,
    width: int = POSITION_BLOCK,
) -> DataFrame:
    """Number the peaks of each arm from 1, in (CHROM, marker_index) order.

    ``significant`` holds significant markers only, with marker_index. A new
    peak starts on another chromosome or when the index moves on by
    ``snp_grouping`` or more. Breaks are found inside position blocks; a block
    summary (first index, last index, breaks) carries the count across them.
    """
    blocked = significant.withColumn("_block", block_of(F.col("POS"), width))
    local = Window.partitionBy(*keys, "CHROM", "_block").orderBy("marker_index")
    gap = F.col("marker_index") - F.lag("marker_index").over(local)
    marked = blocked.withColumn("_break", F.when(gap >= snp_grouping, 1).otherwise(0))

    summary = marked.groupBy(*keys, "CHROM", "_block").agg(
        F.min("marker_index").alias("_first"),
        F.max("marker_index").alias("_last"),
        F.sum("_break").alias("_breaks"),
    )
    ordered = Window.partitionBy(*keys).orderBy("CHROM", "_block")
    same_chrom = F.lag("CHROM").over(ordered) == F.col("CHROM")
    near = F.col("_first") - F.lag("_last").over(ordered) < snp_grouping
    opened = summary.withColumn("_opens", F.when(same_chrom & near, 0).otherwise(1))
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    base = opened.select(
        *keys,
        "CHROM",
        "_block",
        (
            F.coalesce(F.sum(F.col("_opens") + F.col("_breaks")).over(earlier), F.lit(0))
            + F.col("_opens")
        ).alias("_base"),
    )
    # Repeated rows of a marker share its index: whichever of them has the break, all are behind it.
    running = local.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        marked.join(base, [*keys, "CHROM", "_block"])
        .withColumn("peak_id", (F.col("_base") + F.sum("_break").over(running)).cast("int"))
        .drop("_block", "_break", "_base")
    )


def peak_summary(peaked: DataFrame, keys: tuple[str, ...] = ARM) -> DataFrame:
    """One row per peak: index range, marker count and the top marker.

    The top marker has the highest log10p; ties go to the first in
    (CHROM, POS) order. A struct maximum keeps this a map-side combined
    aggregate, so no peak is ever gathered in one task.
    """
    extra = [c for c in ("AF1", "BETA") if c in peaked.columns]
    top = F.max(
        F.struct(
            F.col("log10p"),
            (-F.col("marker_index")).alias("_rank"),
            F.col("POS"),
            F.col("marker"),
            *[F.col(c) for c in extra],
        )
    )
    grouped = peaked.groupBy(*keys, "peak_id", "CHROM").agg(
        F.min("marker_index").alias("_min_index"),
        F.max("marker_index").alias("_max_index"),
        F.sum("significant").cast("int").alias("n_sig_markers"),
        F.first("sig_threshold_value").alias("sig_threshold_value"),
        F.max("_total").alias("_total"),
        top.alias("_top"),
    )
    return grouped.select(
        *keys,
        "peak_id",
        "CHROM",
        "_min_index",
        "_max_index",
        "_total",
        "n_sig_markers",
        "sig_threshold_value",
        F.col("_top.log10p").alias("max_log10p"),
        F.col("_top.POS").alias("peakPOS"),
        F.col("_top.marker").alias("peak_marker"),
        *[F.col(f"_top.{c}").alias(f"peak_{c}") for c in extra],
    )


def interval_bounds(
    peaks: DataFrame,
    index: DataFrame,
    ci_size: int = 150,
    keys: tuple[str, ...] = ARM,
    index_keys: tuple[str, ...] = ("mapping_id",),
) -> DataFrame:
    """Turn index ranges widened by ``ci_size`` into startPOS, endPOS and interval_size.

    ``index`` is :func:`position_index` of the mappings. The block holding a
    marker index is found by an equi-join: a block is listed under every run of
    ``INDEX_BUCKET`` marker indices it touches. The position itself is an array
    element. The work of a peak does not depend on the length of its chromosome.
    """

    def bucket(at):
        return F.floor((at - 1) / F.lit(INDEX_BUCKET))

    last = F.col("_before") + F.size("_positions")
    listed = index.select(
        *index_keys,
        "CHROM",
        F.col("_before").alias("_skip"),
        "_positions",
        F.explode(F.sequence(bucket(F.col("_before") + 1), bucket(last))).alias("_bucket"),
    )
    out = peaks.select(
        *peaks.columns,
        F.greatest(F.col("_min_index") - ci_size, F.lit(1)).alias("_low"),
        F.least(F.col("_max_index") + ci_size, F.col("_total")).alias("_high"),
    )
    for side, name in (("_low", "startPOS"), ("_high", "endPOS")):
        place = (F.col(side) - F.col("_skip")).cast("int")
        out = (
            out.withColumn("_bucket", bucket(F.col(side)))
            .join(listed, [*index_keys, "CHROM", "_bucket"])
            .where((place >= 1) & (place <= F.size("_positions")))
            .withColumn(name, F.element_at("_positions", place))
            .drop("_skip", "_positions", "_bucket")
        )
    return out.withColumn("interval_size", F.col("endPOS") - F.col("startPOS")).drop("_low", "_high")


def significant_with_index(
    mappings: DataFrame, thresholds: DataFrame, index: DataFrame, width: int = POSITION_BLOCK
) -> DataFrame:
    """Significant rows only, each with its marker_index.

    Only rows that pass a threshold leave the scan; they meet the packed
    positions of their block, so insignificant rows are never shuffled whole.
    """
    hits = flag_significant(mappings, thresholds).where(F.col("significant") == 1)
    hits = hits.withColumn("_block", block_of(F.col("POS"), width))
    return (
        hits.join(index, ["mapping_id", "CHROM", "_block"])
        .withColumn(
            "marker_index",
            (F.col("_before") + F.array_position("_positions", F.col("POS"))).cast("int"),
        )
        .drop("_block", "_before", "_positions")
    )


def detect(
    mappings: DataFrame,
    thresholds: DataFrame,
    ci_size: int = 150,
    snp_grouping: int = 1000,
    width: int = POSITION_BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """(significant markers with peak_id, peaks with intervals) for every arm.

    Markers must be unique per mapping and position, as ingest guarantees
    (``dedup_first``) and ``dq_unique_markers`` reports.

    The position index and the significant markers feed several branches each,
    so both are staged: the mappings are scanned twice in all, once for three
    narrow columns and once with everything but the hits dropped at the scan.
    """
    mappings = ensure_position(mappings)
    index = stage(position_index(mappings, width=width), "position-index")
    hits = stage(significant_with_index(mappings, thresholds, index, width), "significant")
    peaked = assign_peaks(hits, snp_grouping, width=width)
    peaks = interval_bounds(peak_summary(peaked), index, ci_size)
    return peaked, peaks


def analyze(
    mappings: DataFrame,
    thresholds: DataFrame,
    ci_size: int = 150,
    snp_grouping: int = 1000,
    width: int = POSITION_BLOCK,
) -> DataFrame:
    """Every mapping row per threshold with flag, peak and interval columns.

    Rows outside peaks keep null peak and interval columns; a mapping without
    significant markers keeps all its rows.
    """
    mappings = ensure_position(mappings)
    thresholds = stage(thresholds, "thresholds")
    peaked, peaks = detect(mappings, thresholds, ci_size, snp_grouping, width)
    members = peaked.select(*ARM, "marker", "peak_id").join(
        peaks.select(*ARM, "peak_id", "startPOS", "peakPOS", "endPOS", "interval_size"),
        [*ARM, "peak_id"],
    )
    return flag_significant(mappings, thresholds).join(members, [*ARM, "marker"], "left")


def confidence_intervals(df: DataFrame, ci_size: int = 150) -> DataFrame:
    """Add interval columns to rows that already carry peak_id, log10p and significant.

    The index is staged: four joins read it, and each would compute ``df`` again.
    """
    index = stage(position_index(df, keys=ARM), "arm-index")
    rows = df.where(F.col("peak_id").isNotNull()).withColumn("_block", block_of(F.col("POS")))
    indexed = (
        rows.join(index, [*ARM, "CHROM", "_block"])
        .withColumn(
            "marker_index",
            (F.col("_before") + F.array_position("_positions", F.col("POS"))).cast("int"),
        )
        .drop("_block", "_before", "_positions")
    )
    peaks = interval_bounds(peak_summary(indexed), index, ci_size, index_keys=ARM)
    return df.join(
        peaks.select(*ARM, "peak_id", "startPOS", "peakPOS", "endPOS", "interval_size"),
        [*ARM, "peak_id"],
        "left",
    )


def peak_markers(analyzed: DataFrame) -> DataFrame:
    """The top marker row of every peak: highest log10p, then lowest position."""
    keys = [*ARM, "peak_id"]
    columns = ["marker", "CHROM", "POS", "AF1", "BETA", "startPOS", "peakPOS", "endPOS"]
    columns += ["interval_size"]
    top = F.max(
        F.struct(
            F.col("log10p"),
            (-F.col("POS")).alias("_rank"),
            F.struct(*columns).alias("row"),
        )
    )
    return (
        analyzed.where(F.col("peak_id").isNotNull())
        .groupBy(*keys)
        .agg(top.alias("_top"))
        .select(*keys, F.col("_top.log10p").alias("log10p"), "_top.row.*")
        .withColumn("detected_peak", F.col("marker"))
    )
