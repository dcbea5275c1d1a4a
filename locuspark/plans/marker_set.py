"""From a variant file to a stored marker set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.functions.genotype import recode_gt
from locuspark.operators import genotype as G
from locuspark.operators import linkage
from locuspark.session import stage
from locuspark.sources.genotypes import read_contigs, read_vcf


def build_marker_set(
    spark: SparkSession,
    vcf: str,
    samples: DataFrame,
    marker_set_id: str,
    maf: float,
    ld: float,
    drop_contig: str | None = "MtDNA",
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(markers, genotypes) after sample subset, quality control and pruning."""
    calls = stage(
        G.rename_chrom(
            G.subset_samples(
                read_vcf(spark, vcf, partitions).where(F.col("CHROM") != (drop_contig or "")),
                samples,
            ),
            read_contigs(spark, vcf),
        ),
        "calls",
    )
    passed = stage(G.variant_qc(calls, maf), "passed")
    good = G.keep_markers(calls, passed).withColumn("marker_set_id", F.lit(marker_set_id))
    # Linkage is that of the called genotypes, heterozygous ones included; codes come after pruning.
    dosages = good.select("marker_set_id", "CHROM", "POS", "strain", G.alt_dosage(F.col("gt")).alias("allele"))
    frequencies = passed.select(F.lit(marker_set_id).alias("marker_set_id"), "CHROM", "POS", F.col("maf").alias("af"))
    removed = linkage.ld_prune(linkage.ld_pairs(dosages), frequencies, ld)
    kept = good.join(removed, ["marker_set_id", "CHROM", "POS"], "left_anti")
    kept = stage(kept.withColumn("allele", recode_gt(F.col("gt"))), "typed")
    markers = (
        passed.join(kept.select("CHROM", "POS").distinct(), ["CHROM", "POS"], "left_semi")
        .withColumns(
            {
                "marker_set_id": F.lit(marker_set_id),
                "marker": F.concat_ws(":", "CHROM", "POS"),
            }
        )
        .select(
            "marker_set_id",
            "marker",
            "CHROM",
            "POS",
            F.col("REF").alias("A1"),
            F.col("ALT").alias("A2"),
        )
    )
    return markers, kept.select("marker_set_id", "CHROM", "POS", "strain", "allele")
