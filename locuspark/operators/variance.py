"""Variance explained by causal variants and by markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_genotypes(
    genotypes: DataFrame, causal_genotypes: DataFrame, causal: DataFrame, traits: DataFrame
) -> DataFrame:
    """trait_id, QTL, CHROM, POS, strain, allele at the causal positions of every trait.

    Where a trait has its own causal genotypes at a position they are used;
    the marker genotypes supply the other positions.
    """
    positions = causal.select("trait_id", "QTL", "CHROM", "POS").distinct()
    own = positions.join(
        causal_genotypes.select("trait_id", "CHROM", "POS", "strain", "allele"),
        ["trait_id", "CHROM", "POS"],
    )
    covered = causal_genotypes.select("trait_id", "CHROM", "POS").distinct()
    shared = (
        positions.join(covered, ["trait_id", "CHROM", "POS"], "left_anti")
        .join(traits.select("trait_id", "marker_set_id"), "trait_id")
        .join(genotypes, ["marker_set_id", "CHROM", "POS"])
        .drop("marker_set_id")
    )
    return shared.unionByName(own)


def non_marker_causal(causal: DataFrame, genotypes: DataFrame, traits: DataFrame) -> DataFrame:
    """Causal variants at positions the genotype table does not have."""
    known = genotypes.select("marker_set_id", "CHROM", "POS").distinct()
    return (
        causal.join(traits.select("trait_id", "marker_set_id"), "trait_id")
        .join(known, ["marker_set_id", "CHROM", "POS"], "left_anti")
        .select("trait_id", "QTL", "CHROM", "POS")
    )


def genotype_phenotype(genotypes: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """Genotypes at causal positions with the trait's phenotype; unmatched strains drop out."""
    return genotypes.join(phenotypes, ["trait_id", "strain"])


def strain_overlap(genotypes: DataFrame, phenotypes: DataFrame) -> DataFrame:
    """Strains per trait that have both a genotype and a phenotype (0 when none)."""
    typed = genotypes.select("trait_id", "strain").distinct()
    common = (
        typed.join(phenotypes.select("trait_id", "strain"), ["trait_id", "strain"], "left_semi")
        .groupBy("trait_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        typed.select("trait_id")
        .distinct()
        .join(common, "trait_id", "left")
        .select("trait_id", F.coalesce("_n", F.lit(0)).alias("n_common_strains"))
    )


def variance_explained(joined: DataFrame, keys: tuple[str, ...] = ("trait_id", "QTL")) -> DataFrame:
    """Between-class share of the phenotype's sum of squares, per causal variant.

    Two aggregates: class count, mean and spread (combined map-side), then the
    few classes of each variant. Unknown with under two classes, a class of
    fewer than two strains, or no variation.
    """
    classes = (
        joined.where(F.col("allele").isNotNull())
        .groupBy(*keys, "allele")
        .agg(
            F.count("phenotype").cast("double").alias("n"),
            F.avg("phenotype").alias("mean"),
            F.var_pop("phenotype").alias("spread"),
        )
    )
    grouped = classes.groupBy(*keys).agg(
        F.collect_list(F.struct("n", "mean", "spread")).alias("_classes"),
        F.min("n").alias("_least"),
        F.count(F.lit(1)).alias("_k"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_grand"),
    )

    def total(term):
        return F.aggregate("_classes", F.lit(0.0), lambda acc, c: acc + term(c))

    between = total(
        lambda c: c["n"] * (c["mean"] - F.col("_grand")) * (c["mean"] - F.col("_grand"))
    )
    within = total(lambda c: c["n"] * c["spread"])
    measured = grouped.withColumns({"_between": between, "_within": within})
    whole = F.col("_between") + F.col("_within")
    usable = (F.col("_k") >= 2) & (F.col("_least") >= 2) & (whole > 0)
    present = joined.select(*keys).distinct()
    return present.join(
        measured.select(
            *keys, F.when(usable, F.col("_between") / whole).alias("Simulated_QTL_VarExp")
        ),
        list(keys),
        "left",
    )


def marker_r2(joined: DataFrame, keys: tuple[str, ...] = ("trait_id", "marker")) -> DataFrame:
    """Squared correlation of phenotype and allele over complete pairs."""
    complete = F.col("phenotype").isNotNull() & F.col("allele").isNotNull()
    value = F.when(complete, F.col("phenotype"))
    allele = F.when(complete, F.col("allele"))
    shared = F.covar_pop(value, allele)
    spread = F.var_pop(value) * F.var_pop(allele)
    return joined.groupBy(*keys).agg(
        F.when(spread > 0, shared * shared / spread).alias("var_exp")
    )
