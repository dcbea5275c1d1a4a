"""Order along a chromosome without one task per chromosome.

A window over (mapping, chromosome) puts a whole mapping into one task. Here
positions fall into blocks of fixed width, so a block holds at most ``width``
distinct positions however hot its mapping is. Ordering is local to a block;
what crosses blocks is carried by one small summary row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION_BLOCK = 1_000_000


def block_of(pos: Column, width: int = POSITION_BLOCK) -> Column:
    return F.floor(pos / F.lit(width)).cast("int")


def block_offsets(blocked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before each block and rows per chromosome: keys, CHROM, _block, _before, _total.

    ``blocked`` carries one row per marker with a ``_block`` column. The windows
    below see one row per block, so their groups are bounded by the genome
    length over the block width.
    """
    counts = blocked.groupBy(*keys, "CHROM", "_block").agg(F.count(F.lit(1)).alias("_n"))
    chrom = Window.partitionBy(*keys, "CHROM")
    earlier = chrom.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *keys,
        "CHROM",
        "_block",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(chrom).alias("_total"),
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    name: str,
    order: Sequence[str] = ("POS", "marker"),
    width: int = POSITION_BLOCK,
) -> DataFrame:
    """Inclusive running sum of ``value`` along each chromosome."""
    blocked = df.withColumns({"_block": block_of(F.col("POS"), width), "_value": value})
    per_block = blocked.groupBy(*keys, "CHROM", "_block").agg(F.sum("_value").alias("_subtotal"))
    earlier = (
        Window.partitionBy(*keys, "CHROM")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_block.select(
        *keys,
        "CHROM",
        "_block",
        F.coalesce(F.sum("_subtotal").over(earlier), F.lit(0)).alias("_carried"),
    )
    local = (
        Window.partitionBy(*keys, "CHROM", "_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        blocked.join(carried, [*keys, "CHROM", "_block"])
        .withColumn(name, F.col("_carried") + F.coalesce(F.sum("_value").over(local), F.lit(0)))
        .drop("_block", "_value", "_carried")
    )


def marker_index(
    df: DataFrame,
    keys: Sequence[str] = ("mapping_id",),
    order: Sequence[str] = ("POS", "marker"),
    width: int = POSITION_BLOCK,
) -> DataFrame:
    """Position of every marker within its chromosome, from 1."""
    blocked = df.withColumn("_block", block_of(F.col("POS"), width))
    offsets = block_offsets(blocked, keys).drop("_total")
    local = Window.partitionBy(*keys, "CHROM", "_block").orderBy(*order)
    return (
        blocked.join(offsets, [*keys, "CHROM", "_block"])
        .withColumn("marker_index", (F.col("_before") + F.row_number().over(local)).cast("int"))
        .drop("_block", "_before")
    )


def position_index(
    df: DataFrame, keys: Sequence[str] = ("mapping_id",), width: int = POSITION_BLOCK
) -> DataFrame:
    """One row per block: its sorted positions, the markers before it, the chromosome's total.

    This is the only shuffle that sees every marker, and it carries three narrow
    columns. Both the index of a marker and the marker at an index are then
    look-ups in an array of at most ``width`` entries. The window runs over the
    packed rows themselves: joining their counts back would scan and shuffle
    the mappings a second time.
    """
    packed = (
        df.select(*keys, "CHROM", "POS", block_of(F.col("POS"), width).alias("_block"))
        .groupBy(*keys, "CHROM", "_block")
        .agg(F.sort_array(F.collect_list("POS")).alias("_positions"))
    )
    chrom = Window.partitionBy(*keys, "CHROM")
    earlier = chrom.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    size = F.size("_positions")
    return packed.select(
        "*",
        F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias("_before"),
        F.sum(size).over(chrom).alias("_total"),
    )
