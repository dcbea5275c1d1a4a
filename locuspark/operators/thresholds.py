"""Significance thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions.scores import significance_threshold

KNOWN_METHODS = ("BF", "EIGEN", "USER")


def marker_set_thresholds(ms_metadata: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Both thresholds of every marker set; the eigen one is null without tests."""
    return ms_metadata.select(
        "marker_set_id",
        "population",
        "maf",
        "n_markers",
        "n_independent_tests",
        F.lit(float(alpha)).alias("alpha"),
        significance_threshold(F.col("n_markers"), alpha).alias("bf_threshold"),
        significance_threshold(F.col("n_independent_tests"), alpha).alias("eigen_threshold"),
    )


def _checked(methods: Sequence[str], user: float | None) -> list[str]:
    names = [m.upper() for m in methods]
    unknown = [m for m in names if m not in KNOWN_METHODS]
    if unknown:
        raise ValueError(f"unknown significance method: {', '.join(unknown)}")
    if "USER" in names and user is None:
        raise ValueError("the USER method needs a threshold value")
    return names


def mapping_thresholds(
    mappings: DataFrame,
    metadata: DataFrame,
    ms_metadata: DataFrame,
    methods: Sequence[str] = ("BF", "EIGEN"),
    alpha: float = 0.05,
    user: float | None = None,
    bf_count: str = "rows",
    missing: str = "fail",
) -> DataFrame:
    """mapping_id, sig_threshold_method, sig_threshold_value: one row per mapping and method.

    The Bonferroni count is the mapping's own row count, or with
    ``bf_count="marker_set"`` the size of its marker set. A mapping whose count
    is missing or not positive fails the job; with ``missing="skip"`` it has no
    row for that method, and ``missing_thresholds`` reports it.
    """
    if missing not in ("fail", "skip"):
        raise ValueError(f"missing is fail or skip, not {missing}")
    out = _arms(mappings, metadata, ms_metadata, methods, alpha, user, bf_count)
    value = F.col("sig_threshold_value")
    if missing == "fail":
        failed = F.raise_error(F.concat("reason", F.lit(" for "), "mapping_id", F.lit(" "), "sig_threshold_method"))
        value = F.when(value.isNotNull(), value).otherwise(failed)
    else:
        out = out.where(value.isNotNull())
    return out.select("mapping_id", "sig_threshold_method", value.alias("sig_threshold_value"))


def missing_thresholds(
    mappings: DataFrame,
    metadata: DataFrame,
    ms_metadata: DataFrame,
    methods: Sequence[str] = ("BF", "EIGEN"),
    bf_count: str = "rows",
) -> DataFrame:
    """mapping_id, sig_threshold_method, reason of every mapping and method without a threshold."""
    out = _arms(mappings, metadata, ms_metadata, methods, 0.05, 0.0, bf_count)
    return out.where("sig_threshold_value is null").select("mapping_id", "sig_threshold_method", "reason")


def _arms(
    mappings: DataFrame,
    metadata: DataFrame,
    ms_metadata: DataFrame,
    methods: Sequence[str],
    alpha: float,
    user: float | None,
    bf_count: str,
) -> DataFrame:
    """Every mapping under every method, with a threshold or the reason why there is none."""
    names = _checked(methods, user)
    base = metadata.select("mapping_id", "marker_set_id").join(
        ms_metadata.select("marker_set_id", "n_markers", "n_independent_tests"),
        "marker_set_id",
        "left",
    )
    if bf_count == "rows" and "BF" in names:
        counted = mappings.groupBy("mapping_id").agg(F.count(F.lit(1)).alias("_rows"))
        base = base.join(counted, "mapping_id", "left")
    else:
        base = base.withColumn("_rows", F.col("n_markers").cast("long"))
    values = {
        "BF": significance_threshold(F.col("_rows"), alpha),
        "EIGEN": significance_threshold(F.col("n_independent_tests"), alpha),
        "USER": F.lit(None if user is None else float(user)).cast("double"),
    }
    counts = {"BF": F.col("_rows").cast("double"), "EIGEN": F.col("n_independent_tests"), "USER": F.lit(1.0)}
    reason = {name: F.when(counts[name].isNull(), "no test count").when(values[name].isNull(), "no positive test count") for name in names}
    arms = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("sig_threshold_method"),
                    values[name].alias("sig_threshold_value"),
                    reason[name].alias("reason"),
                )
                for name in names
            ]
        )
    )
    return base.select("mapping_id", arms.alias("_arm")).select("mapping_id", "_arm.*")
