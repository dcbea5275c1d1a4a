"""Variant and genotype tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.functions.genotype import HOM_ALT, HOM_REF

# Calls that count as missing, the missing-rate limit and the
# frequency bounds of the independent-test count.
MISSING_CALLS = (".", "./.", ".|.")
HET_CALLS = ("0/1", "1/0", "0|1", "1|0")
MAX_MISSING = 0.1
MIN_AF = 0.05

VARIANT = ("CHROM", "POS", "ID", "REF", "ALT")


def rename_chrom(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Contig names become their ordinal in the header; unknown names stay."""
    names = contigs.select(
        F.col("contig").alias("CHROM"), F.col("ordinal").cast("string").alias("_ordinal")
    )
    return (
        df.join(names, "CHROM", "left")
        .withColumn("CHROM", F.coalesce("_ordinal", "CHROM"))
        .select(*df.columns)
    )


def melt_genotypes(wide: DataFrame) -> DataFrame:
    """One column per strain becomes one row per strain."""
    fixed = ["CHROM", "POS"]
    strains = [c for c in wide.columns if c not in (*fixed, "REF", "ALT")]
    typed = wide.select(*fixed, *[F.col(f"`{s}`").cast("double").alias(s) for s in strains])
    return typed.unpivot(fixed, [f"`{s}`" for s in strains], "strain", "allele")


def subset_samples(variants: DataFrame, samples: DataFrame) -> DataFrame:
    """Listed samples only, then only variants without any missing call among them."""
    kept = variants.join(samples.select("strain").distinct(), "strain", "left_semi")
    missing = F.col("gt").isNull() | F.col("gt").isin(*MISSING_CALLS)
    holes = kept.where(missing).select("CHROM", "POS").distinct()
    return kept.join(holes, ["CHROM", "POS"], "left_anti")


def alt_dosage(gt: Column) -> Column:
    """Alternative alleles in a biallelic call; null when the call is missing."""
    return (
        F.when(gt.isin(*HOM_REF), F.lit(0.0))
        .when(gt.isin(*HET_CALLS), F.lit(1.0))
        .when(gt.isin(*HOM_ALT), F.lit(2.0))
    )


def variant_statistics(variants: DataFrame) -> DataFrame:
    """Per variant: share of missing calls and frequency of the rarer allele."""
    dosage = variants.withColumn("_alt", alt_dosage(F.col("gt")))
    alt = F.avg("_alt") / 2
    return dosage.groupBy(*VARIANT).agg(
        (F.count(F.when(F.col("_alt").isNull(), 1)) / F.count(F.lit(1))).alias("missing_rate"),
        F.least(alt, 1 - alt).alias("maf"),
    )


def variant_qc(
    variants: DataFrame, maf: float, geno: float = MAX_MISSING, drop_chrom: str | None = None
) -> DataFrame:
    """Common, well-typed, biallelic SNPs off the dropped chromosome; empty ids become CHROM:POS.

    Conditions on the variant alone run before the aggregate, so long alleles
    and multi-allelic sites never reach the shuffle.
    """
    shape = (
        (F.length("REF") == 1)
        & (F.length("ALT") == 1)
        & ~F.col("ALT").contains(",")
        & ~F.col("ALT").isin(".", "*")
    )
    if drop_chrom is not None:
        shape = shape & (F.col("CHROM") != drop_chrom)
    stats = variant_statistics(variants.where(shape)).where(
        (F.col("missing_rate") <= geno) & (F.col("maf") >= maf)
    )
    own = F.when(F.col("ID").isNotNull() & (F.col("ID") != "."), F.col("ID"))
    return stats.withColumn("ID", F.coalesce(own, F.concat_ws(":", "CHROM", "POS")))


def keep_markers(genotypes: DataFrame, markers: DataFrame) -> DataFrame:
    keys = ["CHROM", "POS"]
    if "marker_set_id" in genotypes.columns and "marker_set_id" in markers.columns:
        keys = ["marker_set_id", *keys]
    return genotypes.join(markers.select(*keys).distinct(), keys, "left_semi")


def complete_markers(genotypes: DataFrame) -> DataFrame:
    """Genotypes of markers without any unknown strain."""
    keys = [c for c in ("marker_set_id", "CHROM", "POS") if c in genotypes.columns]
    holes = genotypes.where(F.col("allele").isNull()).select(*keys).distinct()
    return genotypes.join(holes, keys, "left_anti")


def allele_frequency(
    genotypes: DataFrame, low: float | None = MIN_AF, high: float | None = None
) -> DataFrame:
    """Share of alternative alleles over all strains, within [low, 1 - low]."""
    keys = [c for c in ("marker_set_id", "CHROM", "POS") if c in genotypes.columns]
    out = genotypes.groupBy(*keys).agg(
        (F.coalesce(F.sum(F.when(F.col("allele") == 1, 1.0)), F.lit(0.0)) / F.count(F.lit(1))).alias(
            "af"
        )
    )
    if low is None:
        return out
    high = 1 - low if high is None else high
    return out.where((F.col("af") >= low) & (F.col("af") <= high))


def region_join(variants: DataFrame, bed: DataFrame, width: int = 1_000_000) -> DataFrame:
    """Variants inside listed ranges, ends included.

    Ranges of any length: each is listed under every block it touches and a
    variant has one block, so the join key bounds what meets.
    """
    ranges = bed.select(
        F.col("chrom").cast("string").alias("CHROM"),
        "start",
        "end",
        F.explode(
            F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))
        ).alias("_block"),
    )
    return (
        variants.withColumn("_block", F.floor(F.col("POS") / width))
        .join(ranges, ["CHROM", "_block"])
        .where(F.col("POS").between(F.col("start"), F.col("end")))
        .drop("_block")
    )
