"""Agreement of two assessment runs, and of raw with stored results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions.names import normalize_algorithm
from locuspark.functions.scores import interval_jaccard
from locuspark.operators.grid import require_unique
from locuspark.operators.performance import designate

# The key of one (mapping, QTL) row and of one mapping.
PAIR_KEY = (
    "nQTL simREP h2 maf effect_distribution strain_set_id norm_alg QTL"
).split()
MAPPING_KEY = "nQTL simREP h2 maf strain_set_id norm_alg".split()
_SIDES = ("Detected", "designation", "startPOS", "endPOS")


def pair_assessments(a: DataFrame, b: DataFrame) -> DataFrame:
    """One-to-one inner join on the row key; a repeated key on either side fails."""
    sides = []
    for df, suffix in ((a, "_a"), (b, "_b")):
        keyed = designate(df).withColumn("norm_alg", normalize_algorithm(F.col("algorithm_id")))
        narrow = keyed.select(*PAIR_KEY, *[F.col(c).alias(c + suffix) for c in _SIDES])
        sides.append(require_unique(narrow, PAIR_KEY))
    return sides[0].join(sides[1], PAIR_KEY)


def _agreement(pairs: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    same = F.col(f"{column}_a") == F.col(f"{column}_b")
    return pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_qtl"),
        F.count(F.when(same, 1)).alias("n_agree"),
        F.avg(F.when(same, 1.0).otherwise(0.0)).alias(name),
    )


def detection_concordance(pairs: DataFrame, keys: Sequence[str] = MAPPING_KEY) -> DataFrame:
    return _agreement(pairs, keys, "Detected", "detection_concordance")


def designation_concordance(pairs: DataFrame, keys: Sequence[str] = MAPPING_KEY) -> DataFrame:
    known = pairs.where(F.col("designation_a").isNotNull() & F.col("designation_b").isNotNull())
    return _agreement(known, keys, "designation", "designation_concordance")


def interval_concordance(pairs: DataFrame, keys: Sequence[str] = MAPPING_KEY) -> DataFrame:
    """Mean interval overlap over QTL both runs detected, and how many match perfectly."""
    ends = ("startPOS_a", "endPOS_a", "startPOS_b", "endPOS_b")
    both = pairs.where(F.col("Detected_a") & F.col("Detected_b")).dropna(subset=list(ends))
    scored = both.withColumn("_jaccard", interval_jaccard(*[F.col(c) for c in ends]))
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_intervals"),
        F.count(F.when(F.col("_jaccard") == 1, 1)).alias("n_perfect"),
        F.avg("_jaccard").alias("interval_concordance"),
    )


def compare_assessments(
    pairs: DataFrame, by: Sequence[str] = MAPPING_KEY
) -> DataFrame:
    """The three concordance scores per group."""
    keys = list(by)
    return (
        detection_concordance(pairs, keys)
        .select(*keys, "n_qtl", "detection_concordance")
        .join(
            designation_concordance(pairs, keys).select(*keys, "designation_concordance"),
            keys,
            "left",
        )
        .join(
            interval_concordance(pairs, keys).select(*keys, "n_intervals", "interval_concordance"),
            keys,
            "left",
        )
    )


def roundtrip_diff(
    raw: DataFrame,
    stored: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = ("mapping_id", "marker"),
    tol: float = 1e-12,
) -> DataFrame:
    """Markers on one side only, or whose values differ by more than ``tol``."""
    left = raw.select(*keys, *[F.col(c).alias(f"{c}_raw") for c in cols]).withColumn(
        "_raw", F.lit(True)
    )
    right = stored.select(*keys, *[F.col(c).alias(f"{c}_stored") for c in cols]).withColumn(
        "_stored", F.lit(True)
    )
    joined = left.join(right, list(keys), "full")
    differs = F.lit(False)
    for c in cols:
        a, b = F.col(f"{c}_raw"), F.col(f"{c}_stored")
        differs = differs | F.coalesce(F.abs(a - b) > tol, a.isNull() != b.isNull())
    problem = (
        F.when(F.col("_stored").isNull(), "only_raw")
        .when(F.col("_raw").isNull(), "only_stored")
        .when(differs, "value")
    )
    return (
        joined.withColumn("problem", problem)
        .where(F.col("problem").isNotNull())
        .drop("_raw", "_stored")
    )
