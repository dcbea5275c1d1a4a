"""Genotype tables and variant files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locuspark.functions.scores import split_marker
from locuspark.operators.genotype import melt_genotypes
from locuspark.sources.bgzf import is_block_gzip, read_block_gzip
from locuspark.sources.lines import number


def read_causal_genotypes_tsv(
    spark: SparkSession, path: str, trait_id: str | None = None
) -> DataFrame:
    """Genotypes at causal positions; the trait is given or taken from the path.

    The id is the path component that starts with twenty hex digits, so one call
    reads the files of all traits.
    """
    raw = (
        spark.read.option("recursiveFileLookup", "true")
        .schema("QTL string, strain string, allele string")
        .csv(path, sep="\t", header=True, nullValue="NA")
        .withColumn("_path", F.col("_metadata.file_path"))
    )
    own = (
        F.lit(trait_id)
        if trait_id is not None
        else F.regexp_extract("_path", r"[/=]([0-9a-f]{20})[^0-9a-f]", 1)
    )
    place = split_marker(F.col("QTL"))
    return raw.select(
        own.alias("trait_id"),
        "QTL",
        place["chrom"].alias("CHROM"),
        place["pos"].alias("POS"),
        "strain",
        number(F.col("allele")).alias("allele"),
    )


def read_genotype_matrix_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A wide matrix (one column per strain) as one row per strain."""
    wide = spark.read.csv(path, sep="\t", header=True, nullValue="NA")
    return melt_genotypes(wide.withColumn("POS", F.col("POS").cast("long")))


def variant_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """value, source_file, start (of the split): every line of a variant file, or of all files in a folder.

    Block-gzip files are read in ranges. Any other gzip file is a single split;
    ``partitions`` spreads its lines.
    """
    if is_block_gzip(spark, path):
        return read_block_gzip(spark, path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start"))
    return lines.repartition(partitions) if partitions else lines


def read_vcf(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Variants as one row per sample: CHROM, POS, ID, REF, ALT, strain, gt.

    Only the sample-name lines are looked up first. Files of a folder have to
    name the same samples in the same order, and every variant has to have a
    call for each of them; anything else is an error.
    """
    lines = variant_lines(spark, path, partitions)
    heads = lines.where(F.col("value").startswith("#CHROM")).select(F.regexp_replace("value", r"\s+$", "").alias("value"))
    # At most one distinct line; the second one only proves the disagreement.
    found = [r["value"] for r in heads.distinct().limit(2).collect()]
    if not found:
        raise ValueError(f"no line of sample names in {path}")
    if len(found) > 1:
        raise ValueError(f"files in {path} name different samples")
    names = found[0].split("\t")[9:]
    body = lines.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    cells = body.select(F.split("value", "\t").alias("_c"), "source_file")
    wrong = F.concat("source_file", F.lit(": "), F.size("_c").cast("string"), F.lit(f" fields instead of {9 + len(names)} at "), F.array_join(F.slice("_c", 1, 2), ":"))
    cells = cells.where(F.when(F.size("_c") == 9 + len(names), True).otherwise(F.raise_error(wrong).cast("boolean")))
    samples = F.array(*[F.lit(n) for n in names])
    calls = cells.select(
        *[
            F.try_element_at(F.col("_c"), F.lit(i)).alias(n)
            for i, n in enumerate(("CHROM", "POS", "ID", "REF", "ALT"), 1)
        ],
        F.posexplode(F.slice("_c", 10, max(len(names), 1))).alias("_i", "_call"),
    )
    return calls.select(
        "CHROM",
        F.col("POS").cast("long").alias("POS"),
        "ID",
        "REF",
        "ALT",
        F.element_at(samples, F.col("_i") + 1).alias("strain"),
        F.substring_index("_call", ":", 1).alias("gt"),
    )


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Contig names of a variant file with their ordinal in the header, the same in every file of a folder."""
    header = variant_lines(spark, path).where(F.col("value").startswith("##contig=<ID="))
    named = header.select(
        F.regexp_extract("value", r"^##contig=<ID=([^,>]+)", 1).alias("contig"),
        "source_file",
        F.struct("start", F.monotonically_increasing_id()).alias("_at"),
    )
    # A handful of header lines.
    placed = named.withColumn("ordinal", F.row_number().over(Window.partitionBy("source_file").orderBy("_at")))
    return placed.groupBy("contig").agg(F.min("ordinal").alias("ordinal"), F.max("ordinal").alias("_other")).select(
        F.when(F.col("ordinal") == F.col("_other"), F.col("ordinal"))
        .otherwise(F.raise_error(F.concat(F.lit("files order contigs differently: "), "contig")).cast("int"))
        .alias("ordinal"),
        "contig",
    )
