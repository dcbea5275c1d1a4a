"""Association results and processed mappings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.operators.sets import missing_columns, union_all
from locuspark.sources.lines import Lines, number, read_lines

# Field order of the two result formats, after splitting on white space.
FIELDS = {
    ".fastGWA": "CHR SNP POS A1 A2 N AF1 BETA SE P".split(),
    ".mlma": "CHR SNP POS A1 A2 AF1 BETA SE P".split(),
}


def gwa_lines(spark: SparkSession, path: str) -> Lines:
    """Every line of association results; the format follows the extension of the path."""
    kind = next((ext for ext in FIELDS if path.rstrip("/").endswith(ext)), None)
    if kind is None:
        raise ValueError(f"unknown association result format: {path}")
    return read_lines(spark, path, FIELDS[kind], ("POS",), ("AF1", "BETA", "SE", "P"), ("SNP", "SNP"))


def read_gwa(spark: SparkSession, paths: str | Iterable[str], bad: str = "fail") -> DataFrame:
    """Association results of one path or several.

    A path may be one file or a folder of part files. Lines are split in the
    scan, so large files are read in parallel. A malformed line fails the job, or
    is left out with ``bad="skip"``; ``gwa_lines`` has the rejects and the counts.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    return union_all(
        gwa_lines(spark, path)
        .rows(bad)
        .select(
            F.col("SNP").alias("marker"),
            F.col("CHR").alias("CHROM"),
            F.col("POS").try_cast("long").alias("POS"),
            "A1",
            "A2",
            *[number(F.col(c)).alias(c) for c in ("AF1", "BETA", "SE", "P")],
            "source_file",
        )
        for path in listed
    )


def read_mapping_tsv(
    spark: SparkSession, path: str, required: Iterable[str] = ("CHROM", "marker", "POS")
) -> DataFrame:
    """A processed mapping with header; names every missing required column."""
    df = spark.read.csv(path, sep="\t", header=True, nullValue="NA")
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"missing columns in {path}: {', '.join(absent)}")
    numeric = ("AF1", "BETA", "SE", "P", "log10p", "var_exp")
    out = df.withColumn("POS", F.col("POS").try_cast("long"))
    return out.withColumns({c: number(F.col(c)) for c in numeric if c in df.columns})
