"""Scores, thresholds, peaks and regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.functions import (
    make_marker,
    safe_log10p,
    split_marker,
    with_position,
)
from locuspark.operators import blocks, intervals, regions, thresholds
from locuspark.suite.domain import ALPHA, CI_SIZE, SNP_GROUPING, Domain
from locuspark.suite.oracle import log10p, rnd
from locuspark.suite.registry import query


def r(c: Column | str, digits: int = 9) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c, digits))


def arm_thresholds(d: Domain, **kw) -> DataFrame:
    return thresholds.mapping_thresholds(
        d.mappings, d.metadata, d.marker_set_metadata, ("BF", "EIGEN"), ALPHA, missing="skip", **kw
    )


def analyzed(d: Domain) -> DataFrame:
    return intervals.analyze(d.mappings, arm_thresholds(d), CI_SIZE, SNP_GROUPING)


def detected(d: Domain) -> tuple[DataFrame, DataFrame]:
    return intervals.detect(d.mappings, arm_thresholds(d), CI_SIZE, SNP_GROUPING)


@query(
    "sca01_safe_log10p",
    f"select mapping_id, marker, {rnd(log10p('P'))} as log10p from mappings",
)
def _(d):
    return d.mappings.select("mapping_id", "marker", r(safe_log10p(F.col("P"))).alias("log10p"))


@query(
    "sca11_split_marker",
    """select marker, split_part(marker, ':', 1) as CHROM,
              cast(split_part(marker, ':', 2) as int) as POS, marker as rejoined from markers""",
)
def _(d):
    parts = split_marker(F.col("marker"))
    return d.markers.select(
        "marker", parts["chrom"].alias("CHROM"), parts["pos"].alias("POS")
    ).withColumn("rejoined", make_marker(F.col("CHROM"), F.col("POS")))


@query(
    "agg04_marker_set_thresholds",
    f"""select marker_set_id, population, maf, n_markers, {rnd('n_independent_tests', 6)} as n_independent_tests,
               {rnd(f'-log10({ALPHA} / n_markers)')} as bf_threshold,
               case when n_independent_tests > 0
                    then {rnd(f'-log10({ALPHA} / n_independent_tests)')} end as eigen_threshold
        from marker_set_metadata""",
)
def _(d):
    out = thresholds.marker_set_thresholds(d.marker_set_metadata, ALPHA)
    return out.select(
        "marker_set_id",
        "population",
        "maf",
        "n_markers",
        r("n_independent_tests", 6).alias("n_independent_tests"),
        r("bf_threshold").alias("bf_threshold"),
        r("eigen_threshold").alias("eigen_threshold"),
    )


@query(
    "agg05_mapping_thresholds",
    f"""select mapping_id, method as sig_threshold_method, {rnd('thr')} as sig_threshold_value from a_thr
        union all select mapping_id, 'USER', cast(4.5 as double) from metadata""",
)
def _(d):
    out = thresholds.mapping_thresholds(
        d.mappings, d.metadata, d.marker_set_metadata, ("BF", "EIGEN", "USER"), ALPHA, user=4.5, missing="skip"
    )
    return out.withColumn("sig_threshold_value", r("sig_threshold_value"))


@query(
    "agg05_missing_thresholds",
    """select m.mapping_id, k.method as sig_threshold_method,
              case when k.n is null then 'no test count' else 'no positive test count' end as reason
       from metadata m left join marker_set_metadata s on s.marker_set_id = m.marker_set_id
       left join (select mapping_id, count(*) as n from mappings group by mapping_id) c on c.mapping_id = m.mapping_id
       cross join lateral (values ('BF', cast(c.n as double)), ('EIGEN', s.n_independent_tests)) k(method, n)
       where k.n is null or k.n <= 0""",
)
def _(d):
    return thresholds.missing_thresholds(d.mappings, d.metadata, d.marker_set_metadata)


@query(
    "win01_marker_index",
    """select mapping_id, marker,
              cast(row_number() over (partition by mapping_id, split_part(marker, ':', 1)
                     order by cast(split_part(marker, ':', 2) as int), marker) as int) as marker_index
       from mappings""",
)
def _(d):
    return blocks.marker_index(with_position(d.mappings)).select(
        "mapping_id", "marker", "marker_index"
    )


@query(
    "win02_peak_grouping",
    """select mapping_id, method as sig_threshold_method, marker, cast(idx as int) as marker_index, peak_id
       from a_peaked""",
)
def _(d):
    peaked, _peaks = detected(d)
    return peaked.select("mapping_id", "sig_threshold_method", "marker", "marker_index", "peak_id")


@query(
    "win03_confidence_intervals",
    """select mapping_id, method as sig_threshold_method, peak_id, CHROM, startPOS, peakPOS, endPOS,
              interval_size from a_peaks""",
)
def _(d):
    flagged = intervals.flag_significant(with_position(d.mappings), arm_thresholds(d))
    peaked, _peaks = detected(d)
    keys = [*intervals.ARM, "marker"]
    with_peaks = flagged.join(peaked.select(*keys, "peak_id"), keys, "left")
    return (
        intervals.confidence_intervals(with_peaks, CI_SIZE)
        .where(F.col("peak_id").isNotNull())
        .select(
            *intervals.ARM, "peak_id", "CHROM", "startPOS", "peakPOS", "endPOS", "interval_size"
        )
        .distinct()
    )


@query(
    "win04_peak_markers",
    f"""select mapping_id, method as sig_threshold_method, peak_id, CHROM, peakPOS as POS,
               peak_marker as detected_peak, {rnd('max_log10p')} as log10p, {rnd('peak_AF1')} as AF1,
               {rnd('peak_BETA')} as BETA from a_peaks""",
)
def _(d):
    return intervals.peak_markers(analyzed(d)).select(
        *intervals.ARM,
        "peak_id",
        "CHROM",
        "POS",
        "detected_peak",
        r("log10p").alias("log10p"),
        r("AF1").alias("AF1"),
        r("BETA").alias("BETA"),
    )


_REGIONS_SQL = f"""select mapping_id, method as sig_threshold_method, peak_id, CHROM, startPOS, peakPOS, endPOS,
       interval_size, cast(n_sig as int) as n_sig_markers, {rnd('max_log10p')} as max_log10p, peak_marker,
       {rnd('thr')} as sig_threshold_value from a_peaks"""


def _rounded_regions(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"max_log10p": r("max_log10p"), "sig_threshold_value": r("sig_threshold_value")}
    )


@query("agg06_qtl_regions", _REGIONS_SQL)
def _(d):
    _peaked, peaks = detected(d)
    return _rounded_regions(regions.regions_from_peaks(peaks))


@query("agg06_qtl_regions_of_analyzed", _REGIONS_SQL)
def _(d):
    return _rounded_regions(regions.qtl_regions(analyzed(d)))


_SUMMARY_SQL = f"""select mapping_id, method as threshold_method, count(*) as n_markers,
       cast(coalesce(sum(significant), 0) as bigint) as n_significant,
       round(100.0 * coalesce(sum(significant), 0) / count(*), 2) as pct_significant,
       coalesce(max(peak_id), 0) as n_qtl, round(max(log10p), 4) as max_log10p,
       {rnd('max(thr)')} as threshold_value
  from a_analyzed group by mapping_id, method"""


@query("agg07_detection_summary", _SUMMARY_SQL)
def _(d):
    out = regions.detection_summary(analyzed(d))
    return out.withColumn("threshold_value", r("threshold_value"))


@query("agg07_detection_summary_direct", _SUMMARY_SQL)
def _(d):
    thr = arm_thresholds(d)
    peaked, _peaks = intervals.detect(d.mappings, thr, CI_SIZE, SNP_GROUPING)
    out = regions.summary_from_detection(d.mappings, thr, peaked)
    return out.withColumn("threshold_value", r("threshold_value"))


@query(
    "pip01_analyze",
    f"""select mapping_id, method as sig_threshold_method, marker, CHROM, POS, {rnd('log10p')} as log10p,
               significant, peak_id, startPOS, peakPOS, endPOS, interval_size from a_analyzed""",
)
def _(d):
    return analyzed(d).select(
        *intervals.ARM,
        "marker",
        "CHROM",
        "POS",
        r("log10p").alias("log10p"),
        "significant",
        "peak_id",
        "startPOS",
        "peakPOS",
        "endPOS",
        "interval_size",
    )
