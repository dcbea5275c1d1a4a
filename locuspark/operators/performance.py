"""Detection outcomes, power and false-discovery rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The four outcome names.
DETECTED = "Detected.CV"
MISSED = "Missed.CV"
NOT_SIGNIFICANT = "CV.Not.Significant.In.Interval"
FALSE_DISCOVERY = "False.Discovery"
OUTCOMES = (DETECTED, MISSED, NOT_SIGNIFICANT, FALSE_DISCOVERY)

CELL = ("nQTL", "simREP", "h2", "maf", "effect_distribution", "strain_set_id", "mode", "type")


def column_of(outcome: str) -> str:
    return outcome.replace(".", "_")


def designate(df: DataFrame) -> DataFrame:
    """Add ``designation``; rows matching none of the four outcomes get null."""
    flag = next((c for c in ("significant", "aboveBF") if c in df.columns), None)
    if flag is None:
        raise ValueError("designate needs a 'significant' or 'aboveBF' column")
    sim, det = F.col("Simulated").cast("boolean"), F.col("Detected").cast("boolean")
    sig = F.col(flag).cast("boolean")
    return df.withColumn(
        "designation",
        F.when(sim & det & F.coalesce(sig, F.lit(True)), DETECTED)
        .when(sim & ~det & ~F.coalesce(sig, F.lit(False)), MISSED)
        .when(sim & det & ~sig, NOT_SIGNIFICANT)
        .when(~sim & det, FALSE_DISCOVERY),
    )


def count_outcomes(designated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of the four outcomes per group, zero when absent.

    The values are known, so the pivot needs no pass to find them.
    """
    return designated.groupBy(*keys).agg(
        *[
            F.count(F.when(F.col("designation") == o, 1)).alias(column_of(o))
            for o in OUTCOMES
        ]
    )


def _ratio(top, bottom):
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def power_fdr(counts: DataFrame, stringent: bool = False) -> DataFrame:
    hit, near = F.col(column_of(DETECTED)), F.col(column_of(NOT_SIGNIFICANT))
    missed, false = F.col(column_of(MISSED)), F.col(column_of(FALSE_DISCOVERY))
    return counts.withColumns(
        {"Detected": hit + near + false, "Simulated": hit + near + missed}
    ).withColumns(
        {
            "Power": _ratio(hit if stringent else hit + near, F.col("Simulated")),
            "FDR": _ratio(false, F.col("Detected")),
        }
    )


def power_only(counts: DataFrame) -> DataFrame:
    """Power without the false discoveries, for bins of variance explained."""
    hit, near = F.col(column_of(DETECTED)), F.col(column_of(NOT_SIGNIFICANT))
    missed = F.col(column_of(MISSED))
    return (
        counts.drop(column_of(FALSE_DISCOVERY))
        .withColumns({"Detected": hit + near, "Simulated": hit + near + missed})
        .withColumn("Power", _ratio(hit + near, F.col("Simulated")))
    )


def performance(
    assessment: DataFrame, keys: Sequence[str] = (*CELL, "threshold"), stringent: bool = False
) -> DataFrame:
    """Power and FDR per simulation cell."""
    return power_fdr(count_outcomes(designate(assessment), keys), stringent)
