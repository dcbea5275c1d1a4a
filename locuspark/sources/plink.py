"""Marker lists, sample lists, phenotypes, causal effects and binary genotypes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.functions.scores import make_marker, split_marker
from locuspark.session import path_exists
from locuspark.sources.lines import Lines, number, read_lines

# File signature, and the codes of two bits (low bit first):
# homozygous first allele, missing, heterozygous, homozygous second allele.
BED_MAGIC = b"\x6c\x1b\x01"
ALLELES = (-1.0, None, None, 1.0)
# The fields of the four text formats.
BIM = "CHROM snp cm POS A1 A2".split()
FAM = "fid iid pid mid sex pheno".split()
PHEN = "fid iid value".split()
PAR = "QTL RefAllele Frequency Effect".split()


def bim_lines(spark: SparkSession, path: str, only: str | None = None) -> Lines:
    return read_lines(spark, path, BIM, whole=("POS",), only=only)


def fam_lines(spark: SparkSession, path: str, only: str | None = None) -> Lines:
    return read_lines(spark, path, FAM, numbers=("pheno",), only=only)


def phen_lines(spark: SparkSession, path: str) -> Lines:
    return read_lines(spark, path, PHEN, numbers=("value",))


def par_lines(spark: SparkSession, path: str) -> Lines:
    return read_lines(spark, path, PAR, numbers=("Frequency", "Effect"), header=("QTL", "QTL"))


def read_bim(spark: SparkSession, path: str, bad: str = "fail") -> DataFrame:
    """Marker list; the marker is always CHROM:POS, whatever id the file carries."""
    typed = bim_lines(spark, path).rows(bad).withColumn("POS", F.col("POS").try_cast("long"))
    return typed.select(make_marker(F.col("CHROM"), F.col("POS")).alias("marker"), "CHROM", "POS", "A1", "A2")


def read_fam(spark: SparkSession, path: str, bad: str = "fail") -> DataFrame:
    raw = fam_lines(spark, path).rows(bad)
    return raw.withColumn("pheno", number(F.col("pheno"))).select(*FAM)


def read_phen(spark: SparkSession, path: str, bad: str = "fail") -> DataFrame:
    """Simulated phenotypes: the strain is the family id."""
    raw = phen_lines(spark, path).rows(bad)
    return raw.select(F.col("fid").alias("strain"), number(F.col("value")).alias("phenotype"))


def read_par(spark: SparkSession, path: str, bad: str = "fail") -> DataFrame:
    """Causal effects with CHROM and POS taken from the QTL name."""
    place = split_marker(F.col("QTL"))
    return par_lines(spark, path).rows(bad).select(
        "QTL",
        place["chrom"].alias("CHROM"),
        place["pos"].alias("POS"),
        "RefAllele",
        number(F.col("Frequency")).alias("Frequency"),
        number(F.col("Effect")).alias("Effect"),
    )


def _unpacked(raw: np.ndarray, n: int) -> np.ndarray:
    """Codes of n samples per row of packed bytes."""
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return (bits[:, 0::2] + 2 * bits[:, 1::2])[:, :n]


def decode_packed(packed: DataFrame, strains: list[str]) -> DataFrame:
    """Two-bit packed genotypes (CHROM, POS, bytes) to one row per strain.

    Each batch of variants becomes one bit matrix; heterozygous and missing
    calls are null.
    """
    names = np.array(strains, dtype=object)
    n = len(names)
    value = np.array([np.nan if a is None else a for a in ALLELES])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            raw = np.frombuffer(b"".join(batch["bytes"]), dtype=np.uint8).reshape(len(batch), -1)
            allele = pd.array(value[_unpacked(raw, n)].ravel(), dtype="Float64")
            yield pd.DataFrame(
                {
                    "CHROM": np.repeat(batch["CHROM"].to_numpy(), n),
                    "POS": np.repeat(batch["POS"].to_numpy(), n),
                    "strain": np.tile(names, len(batch)),
                    "allele": allele,
                }
            )

    out = packed.select("CHROM", "POS", "bytes").mapInPandas(
        unpack, "CHROM string, POS long, strain string, allele double"
    )
    return out.withColumn("allele", F.when(~F.isnan("allele"), F.col("allele")))


def read_bed(spark: SparkSession, path: str, markers: DataFrame | None = None, chunk: int = 1024) -> DataFrame:
    """Binary genotypes (CHROM, POS, strain, allele) of one fileset, or of all filesets in a folder.

    A task gets ranges of at most ``chunk`` variants with their positions and the
    samples of their fileset, and reads just these bytes. ``markers`` (CHROM, POS)
    restricts the ranges before anything is read. Every file that is read must
    begin with the signature and have the size its two text files call for.
    """
    if path_exists(spark, f"{path}.bim"):
        bim, fam = bim_lines(spark, f"{path}.bim"), fam_lines(spark, f"{path}.fam")
    else:
        bim, fam = bim_lines(spark, path, "*.bim"), fam_lines(spark, path, "*.fam")
    prefix = F.regexp_replace("path", r"\.(bim|fam)$", "").alias("prefix")
    # Rejects and blank lines would shift everything behind them.
    whole = F.when(F.col("kind") == "row", True).otherwise(F.raise_error(F.concat("source_file", F.lit(": "), F.coalesce("problem", F.lit("blank line")))).cast("boolean"))
    bim, fam = (Lines(x.table.where(whole), x.fields) for x in (bim, fam))
    # One row per fileset: its samples in order, and how many variants it has.
    samples = fam.numbered("row").groupBy(prefix).agg(F.array_sort(F.collect_list(F.struct("line", "iid"))).alias("s")).select("prefix", F.col("s.iid").alias("samples"))
    counts = bim.table.groupBy(prefix).agg(F.count(F.lit(1)).alias("n"))
    places = bim.numbered("row").select(prefix, (F.col("line") - 1).alias("at"), "CHROM", F.col("POS").cast("long").alias("POS"))
    if markers is not None:
        places = places.join(markers.select("CHROM", "POS").distinct(), ["CHROM", "POS"], "left_semi")
    ranges = places.groupBy("prefix", F.floor(F.col("at") / chunk).alias("range")).agg(F.array_sort(F.collect_list(F.struct("at", "CHROM", "POS"))).alias("p"))
    ranges = ranges.select("prefix", "range", *[F.col(f"p.{c}").alias(c) for c in ("at", "CHROM", "POS")])
    # A fileset without a sample list has no samples to join: it fails, instead of vanishing.
    listed = F.when(F.col("samples").isNotNull(), F.col("samples")).otherwise(F.raise_error(F.concat("prefix", F.lit(": no sample list"))))
    work = ranges.join(counts, "prefix").join(samples, "prefix", "left").withColumn("samples", listed)
    value = np.array([np.nan if a is None else a for a in ALLELES])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        # Rows stay in Arrow until their turn: a batch may hold thousands of ranges.
        for batch in batches:
            for k in range(len(batch)):
                prefix, n, samples, at, chrom, pos = [batch.column(c)[k] for c in ("prefix", "n", "samples", "at", "CHROM", "POS")]
                bed = f"{prefix.as_py()}.bed"
                filesystem, file = fs.FileSystem.from_uri(bed)
                strains, at = samples.values, at.values.to_numpy()
                width = (len(strains) + 3) // 4
                with filesystem.open_input_file(file) as source:
                    if source.read_at(3, 0) != BED_MAGIC:
                        raise ValueError(f"not a variant-major binary genotype file: {bed}")
                    if source.size() != 3 + n.as_py() * width:
                        raise ValueError(f"{bed} has {source.size()} bytes; {n} variants of {len(strains)} samples take {3 + n.as_py() * width}")
                    data = source.read_at(int(at[-1] - at[0] + 1) * width, 3 + int(at[0]) * width)
                codes = _unpacked(np.frombuffer(data, np.uint8).reshape(-1, width)[at - at[0]], len(strains))
                each, every = np.repeat(np.arange(len(at)), len(strains)), np.tile(np.arange(len(strains)), len(at))
                yield pa.RecordBatch.from_arrays(
                    [chrom.values.take(pa.array(each)), pos.values.take(pa.array(each)), strains.take(pa.array(every)), pa.array(value[codes].ravel())],
                    names=["CHROM", "POS", "strain", "allele"],
                )

    found = work.select("prefix", "range", "n", "samples", "at", "CHROM", "POS").repartition("prefix", "range")
    found = found.mapInArrow(read, "CHROM string, POS long, strain string, allele double")
    return found.withColumn("allele", F.when(~F.isnan("allele"), F.col("allele")))
