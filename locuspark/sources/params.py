"""Parameter files: test counts, strainfiles, manifests, failure records, value lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.functions.names import parse_eigen_name
from locuspark.operators.sets import missing_columns
from locuspark.schemas import REPLAY_MANIFEST
from locuspark.sources.lines import number

# Fixed value: the manifest columns a replay cannot do without.
MANIFEST_REQUIRED = ("session", "species", "group", "nqtl", "effect", "h2", "rep")


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    """First line of every file below ``path``; such files hold a single number."""
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(
        F.trim(F.regexp_replace(F.substring_index("value", "\n", 1), r"\s+$", "")).alias("text"),
        F.col("_metadata.file_path").alias("path"),
    )


def read_eigen(spark: SparkSession, path: str) -> DataFrame:
    """source_file, n_tests; text that is not a number fails the job."""
    value = F.col("text").try_cast("double")
    return _first_lines(spark, path).select(
        F.col("path").alias("source_file"),
        F.when(value.isNotNull(), value)
        .otherwise(F.raise_error(F.concat(F.lit("not a number in "), F.col("path"))))
        .alias("n_tests"),
    )


def build_eigen_lookup(spark: SparkSession, directory: str) -> DataFrame:
    """population, maf, n_tests, source_file, problem for every test-count file.

    Files whose name cannot be parsed or whose content is no number keep a row
    with ``problem`` set, and no values.
    """
    name = F.regexp_extract("path", r"([^/=]+_total_independent_tests\.txt)", 1)
    named = _first_lines(spark, directory).withColumn("source_file", name)
    parsed = named.where(F.col("source_file") != "").withColumns(
        {"_p": parse_eigen_name(F.col("source_file")), "n_tests": F.col("text").try_cast("double")}
    )
    problem = F.when(
        F.col("_p").isNull() | F.col("_p.maf").isNull(), "unparseable name"
    ).when(F.col("n_tests").isNull(), "not a number")
    return parsed.withColumn("problem", problem).select(
        F.col("_p.population").alias("population"),
        F.col("_p.maf").alias("maf"),
        "n_tests",
        "source_file",
        "problem",
    )


def _tidy(c: str):
    return F.regexp_replace(F.col(f"`{c}`"), r"^\s+|\s+$", "")


def read_strainfile(spark: SparkSession, path: str) -> DataFrame:
    """Groups with trimmed text, lower-case species, numbers and a strain array."""
    raw = spark.read.csv(path, sep="\t", header=True, nullValue="NA")
    aliases = {"population": "group", "maf": "ms_maf"}
    names = {c: aliases.get(c.strip(), c.strip()) for c in raw.columns}
    tidy = raw.select(*[_tidy(c).alias(n) for c, n in names.items()])
    absent = missing_columns(tidy, ("group", "ms_maf"))
    if absent:
        raise ValueError(f"strainfile {path} lacks: {', '.join(absent)}")
    out = tidy.withColumn("ms_maf", number(F.col("ms_maf")))
    if "ms_ld" in out.columns:
        out = out.withColumn("ms_ld", number(F.col("ms_ld")))
    if "species" in out.columns:
        out = out.withColumn("species", F.lower("species"))
    if "strains" in out.columns:
        out = out.withColumn("strain_list", F.split("strains", r"\s*,\s*"))
    return out


def read_replay_manifest(
    spark: SparkSession, path: str, required: Iterable[str] = MANIFEST_REQUIRED
) -> DataFrame:
    """Failed slots to run again; nqtl stays text. The first column must be ``session``."""
    raw = spark.read.csv(path, sep="\t", header=True, nullValue="NA")
    if not raw.columns or raw.columns[0] != "session":
        raise ValueError(f"not a replay manifest (first column is not session): {path}")
    absent = missing_columns(raw, required)
    if absent:
        raise ValueError(f"replay manifest {path} lacks: {', '.join(absent)}")
    kinds = {f.name: f.dataType for f in REPLAY_MANIFEST.fields}
    return raw.select(
        *[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in raw.columns]
    )


def read_failures(
    spark: SparkSession, directory: str, session: str | None = None, one_per_file: bool = True
) -> DataFrame:
    """Failure records of one session; unreadable ones are skipped, keys are united.

    A record is a file of its own, or with ``one_per_file=False`` a line.
    """
    raw = spark.read.json(
        directory,
        multiLine=one_per_file,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="_unreadable",
        pathGlobFilter="*.json",
    )
    if "_unreadable" in raw.columns:
        raw = raw.where(F.col("_unreadable").isNull()).drop("_unreadable")
    return raw if session is None else raw.where(F.col("session") == session)


def read_values(spark: SparkSession, path: str) -> DataFrame:
    """One value per line, blank lines ignored."""
    return (
        spark.read.text(path)
        .select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("value"))
        .where(F.col("value") != "")
    )


def parse_values(df: DataFrame, column: str) -> DataFrame:
    """An inline comma list per row, one value per row."""
    return df.select(
        *[c for c in df.columns if c != column],
        F.explode(F.split(column, ",")).alias("value"),
    ).withColumn("value", F.trim("value")).where(F.col("value") != "")
