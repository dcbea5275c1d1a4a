"""Causal scoring, overlaps, variance explained, outcomes and performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuspark.operators import causal as C
from locuspark.operators import performance as P
from locuspark.operators import sets, variance
from locuspark.operators.intervals import ARM
from locuspark.plans import assess as plan
from locuspark.session import stage
from locuspark.suite.detection import arm_thresholds, detected, r
from locuspark.suite.domain import ALPHA, CI_SIZE, SNP_GROUPING, Domain
from locuspark.suite.oracle import log10p, rnd
from locuspark.suite.registry import query


def scored(d: Domain) -> DataFrame:
    return C.score_causal(d.mappings, arm_thresholds(d), d.metadata, d.causal_variants)


def overlaps(d: Domain) -> tuple[DataFrame, DataFrame, DataFrame]:
    _peaked, peaks = detected(d)
    peaks, rows = stage(peaks, "peaks"), stage(scored(d), "scored")
    return peaks, rows, C.peak_causal_overlaps(peaks, rows)


def merged(d: Domain) -> DataFrame:
    return variance.merge_genotypes(d.genotypes, d.causal_genotypes, d.causal_variants, d.traits)


def assessment(d: Domain) -> DataFrame:
    return plan.assess(
        d.mappings,
        d.metadata,
        d.marker_set_metadata,
        d.traits,
        d.causal_variants,
        d.genotypes,
        d.causal_genotypes,
        d.phenotypes,
        alpha=ALPHA,
        ci_size=CI_SIZE,
        snp_grouping=SNP_GROUPING,
        missing="skip",
    )


def stored_assessment(d: Domain) -> DataFrame:
    """The assessment as a stored table, for the queries that read one."""
    return d.staged("assessment", lambda: assessment(d))


def rounded(df: DataFrame, digits: int = 9, **special: int) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: r(c, special.get(c, digits)) for c in doubles})


@query(
    "joi04_score_causal",
    f"""select mapping_id, method as sig_threshold_method, QTL, CHROM, POS, RefAllele,
               {rnd('Frequency')} as Frequency, {rnd('Effect')} as Effect, {rnd('log10p')} as log10p, significant
        from c_scored""",
)
def _(d):
    return rounded(scored(d))


@query(
    "joi05_peak_causal_overlap",
    f"""select mapping_id, method as sig_threshold_method, CHROM, startPOS, peakPOS, endPOS,
               peak_marker as detected_peak, {rnd('peak_BETA')} as BETA, {rnd('max_log10p')} as interval_log10p,
               cast(null as double) as interval_var_exp, {rnd('peak_AF1')} as interval_Frequency, peak_id,
               interval_size, QTL, POS, RefAllele, {rnd('Frequency')} as Frequency, {rnd('Effect')} as Effect,
               {rnd('log10p')} as log10p, significant from c_overlap""",
)
def _(d):
    return rounded(overlaps(d)[2])


@query(
    "joi06_false_positive_peaks",
    f"""select mapping_id, method as sig_threshold_method, peak_id, peak_marker as QTL, CHROM, peakPOS as POS,
               startPOS, peakPOS, endPOS, {rnd('peak_BETA')} as BETA, {rnd('max_log10p')} as interval_log10p,
               interval_size from c_false""",
)
def _(d):
    peaks, rows, found = overlaps(d)
    out = C.false_positive_peaks(peaks, found, rows).drop(
        "detected_peak", "interval_var_exp", "interval_Frequency"
    )
    return rounded(out)


@query(
    "win06_first_overlap",
    """select mapping_id, method as sig_threshold_method, QTL, peak_id, startPOS, endPOS,
              peak_marker as detected_peak from c_first""",
)
def _(d):
    return C.first_overlap(overlaps(d)[2]).select(
        *ARM, "QTL", "peak_id", "startPOS", "endPOS", "detected_peak"
    )


@query(
    "joi07_assessment_union",
    f"""select mapping_id, method as sig_threshold_method, QTL, Simulated, Detected, CHROM, POS, startPOS,
               peakPOS, endPOS, detected_peak, peak_id, interval_size, top_hit, {rnd('log10p')} as log10p,
               significant from c_union""",
)
def _(d):
    peaks, rows, found = overlaps(d)
    out = C.assessment_union(rows, found, C.false_positive_peaks(peaks, found, rows))
    return rounded(
        out.select(
            *ARM,
            "QTL",
            "Simulated",
            "Detected",
            "CHROM",
            "POS",
            "startPOS",
            "peakPOS",
            "endPOS",
            "detected_peak",
            "peak_id",
            "interval_size",
            "top_hit",
            "log10p",
            "significant",
        )
    )


@query(
    "set04_distinct_ids",
    """select distinct mapping_id, method as sig_threshold_method, QTL from c_union""",
)
def _(d):
    peaks, rows, found = overlaps(d)
    false = C.false_positive_peaks(peaks, found, rows)
    keys = [*ARM, "QTL"]
    return sets.distinct_ids(rows.select(*keys), found.select(*keys).unionByName(false.select(*keys)))


@query(
    "joi08_merge_genotypes",
    "select trait_id, QTL, CHROM, POS, strain, allele from v_merged",
)
def _(d):
    return merged(d)


@query(
    "joi09_non_marker_causal",
    """select c.trait_id, count(*) as n_non_marker
       from causal_variants c join traits t on t.trait_id = c.trait_id
       where not exists (select 1 from genotypes g where g.marker_set_id = t.marker_set_id
                         and g.CHROM = c.CHROM and g.POS = c.POS)
       group by c.trait_id""",
)
def _(d):
    out = variance.non_marker_causal(d.causal_variants, d.genotypes, d.traits)
    return out.groupBy("trait_id").agg(F.count(F.lit(1)).alias("n_non_marker"))


@query(
    "joi10_genotype_phenotype",
    f"""select trait_id, QTL, strain, allele, {rnd('phenotype')} as phenotype from v_joined""",
)
def _(d):
    out = variance.genotype_phenotype(merged(d), d.phenotypes)
    return rounded(out.select("trait_id", "QTL", "strain", "allele", "phenotype"))


@query(
    "agg33_strain_overlap",
    """select m.trait_id, count(distinct case when p.strain is not null then m.strain end) as n_common_strains
       from v_merged m left join phenotypes p on p.trait_id = m.trait_id and p.strain = m.strain
       group by m.trait_id""",
)
def _(d):
    return variance.strain_overlap(merged(d), d.phenotypes)


@query(
    "agg08_variance_explained",
    f"select trait_id, QTL, {rnd('ve', 8)} as Simulated_QTL_VarExp from v_exp",
)
def _(d):
    joined = variance.genotype_phenotype(merged(d), d.phenotypes)
    return rounded(variance.variance_explained(joined), 8)


@query(
    "agg09_marker_r2",
    f"""select trait_id, marker, case when isfinite(rr) then {rnd('rr * rr', 8)} end as var_exp from (
          select p.trait_id, concat(g.CHROM, ':', cast(g.POS as varchar)) as marker,
                 case when count(distinct allele) filter (allele is not null and phenotype is not null) > 1
                       and count(distinct phenotype) filter (allele is not null and phenotype is not null) > 1
                      then corr(p.phenotype, g.allele) end as rr
          from genotypes g join traits t on t.marker_set_id = g.marker_set_id
          join phenotypes p on p.trait_id = t.trait_id and p.strain = g.strain
          group by p.trait_id, concat(g.CHROM, ':', cast(g.POS as varchar))) z""",
)
def _(d):
    # A marker's rows are brought together before traits multiply them: joins with the few traits
    # and phenotypes leave them there, so the aggregate shuffles nothing.
    place = ["marker_set_id", "CHROM", "POS"]
    joined = (
        d.genotypes.repartition(*place)
        .join(d.traits.select("trait_id", "marker_set_id"), "marker_set_id")
        .join(d.phenotypes, ["trait_id", "strain"])
        .select("trait_id", *place, "phenotype", "allele")
    )
    explained = variance.marker_r2(joined, ("trait_id", *place))
    out = explained.select("trait_id", F.concat_ws(":", "CHROM", "POS").alias("marker"), "var_exp")
    return rounded(out, 8)


@query(
    "joi11_causal_pvalues",
    f"""select m.trait_id, m.population, m.mapping_id, m.algorithm, m.pca, x.threshold,
               {rnd('x.v')} as threshold_value, c.QTL, c.CHROM, c.POS, {rnd('f.P', 12)} as P,
               {rnd(log10p('f.P'))} as log10p,
               coalesce({log10p('f.P')} > x.v, case when f.P is null then false end) as detected
        from metadata m
        join (select distinct trait_id, QTL, CHROM, POS from causal_variants) c on c.trait_id = m.trait_id
        join (select marker_set_id, 'BF' as threshold, -log10({ALPHA} / n_markers) as v from marker_set_metadata
              union all select marker_set_id, 'EIGEN', case when n_independent_tests > 0
                               then -log10({ALPHA} / n_independent_tests) end from marker_set_metadata
              union all select marker_set_id, '5.5', cast(5.5 as double) from marker_set_metadata) x
          on x.marker_set_id = m.marker_set_id
        left join mappings f on f.mapping_id = m.mapping_id and f.marker = c.QTL""",
)
def _(d):
    out = C.causal_pvalues(
        d.causal_variants,
        d.mappings,
        d.metadata,
        d.marker_set_metadata,
        ("BF", "EIGEN", "5.5"),
        ALPHA,
    )
    return rounded(out, P=12)


@query(
    "pip02_process_mappings",
    f"""with t2 as (
          select m.mapping_id, x.method, x.thr from metadata m join (
            select marker_set_id, 'BF' as method, -log10({ALPHA} / n_markers) as thr from marker_set_metadata
            union all select marker_set_id, 'EIGEN', -log10({ALPHA} / n_independent_tests)
            from marker_set_metadata where n_independent_tests > 0) x on x.marker_set_id = m.marker_set_id),
        f2 as (select m.mapping_id, t.method, t.thr, {log10p('m.P')} as lp,
                      split_part(marker, ':', 1) as ch, cast(split_part(marker, ':', 2) as int) as pos
               from mappings m join t2 t on t.mapping_id = m.mapping_id),
        i2 as (select *, row_number() over (partition by mapping_id, method, ch order by pos) as idx from f2),
        b2 as (select *, case when lag(ch) over w = ch and idx - lag(idx) over w < {SNP_GROUPING}
                              then 0 else 1 end as brk
               from i2 where lp >= thr window w as (partition by mapping_id, method order by ch, idx)),
        q2 as (select mapping_id, method, count(*) as n_sig, sum(brk) as n_qtl from b2
               group by mapping_id, method)
        select f.mapping_id, f.method as threshold_method, count(*) as n_markers,
               cast(coalesce(max(q.n_sig), 0) as bigint) as n_significant,
               round(100.0 * coalesce(max(q.n_sig), 0) / count(*), 2) as pct_significant,
               cast(coalesce(max(q.n_qtl), 0) as int) as n_qtl, round(max(lp), 4) as max_log10p,
               {rnd('max(f.thr)')} as threshold_value
        from f2 f left join q2 q on q.mapping_id = f.mapping_id and q.method = f.method
        group by f.mapping_id, f.method""",
)
def _(d):
    out = plan.process_mappings(
        d.mappings,
        d.metadata,
        d.marker_set_metadata,
        methods=("BF", "EIGEN"),
        alpha=ALPHA,
        ci_size=CI_SIZE,
        snp_grouping=SNP_GROUPING,
        missing="skip",
    )
    return out.summary.withColumn("threshold_value", r("threshold_value"))


@query("pip03_compile_assessment", "select * exclude (Simulated_QTL_VarExp) from c_assess")
def _(d):
    thr = stage(arm_thresholds(d), "thresholds")
    _peaked, peaks = detected(d)
    out = plan.compile_assessment(
        d.mappings, thr, peaks, d.metadata, d.causal_variants, ALPHA, CI_SIZE, SNP_GROUPING
    )
    return rounded(out.drop("Simulated_QTL_VarExp"))


@query("pip04_assess", "select * from c_assess")
def _(d):
    return rounded(assessment(d), Simulated_QTL_VarExp=8)


@query(
    "sca22_assessment_columns",
    """select * replace (cast(null as double) as Simulated_QTL_VarExp, cast(null as double) as alpha)
       from c_assess""",
)
def _(d):
    return C.assessment_columns(rounded(stored_assessment(d)).drop("Simulated_QTL_VarExp", "alpha"))


@query(
    "pip05_designate",
    """select mode, type, threshold, nQTL, simREP, h2, strain_set_id, QTL, Simulated, Detected, significant,
              designation from c_desig""",
)
def _(d):
    return P.designate(stored_assessment(d)).select(
        "mode",
        "type",
        "threshold",
        "nQTL",
        "simREP",
        "h2",
        "strain_set_id",
        "QTL",
        "Simulated",
        "Detected",
        "significant",
        "designation",
    )


@query("agg10_count_outcomes", "select * from c_counts")
def _(d):
    return P.count_outcomes(P.designate(stored_assessment(d)), (*P.CELL, "threshold"))


_COUNTS = """Detected_CV + CV_Not_Significant_In_Interval + False_Discovery as Detected,
             Detected_CV + CV_Not_Significant_In_Interval + Missed_CV as Simulated"""


@query(
    "agg11_power_fdr_stringent",
    f"""select *, case when Simulated = 0 then cast(0 as double) else {rnd('Detected_CV / Simulated')} end as Power,
               case when Detected = 0 then cast(0 as double) else {rnd('False_Discovery / Detected')} end as FDR
        from (select *, {_COUNTS} from c_counts) z""",
)
def _(d):
    counts = P.count_outcomes(P.designate(stored_assessment(d)), (*P.CELL, "threshold"))
    return rounded(P.power_fdr(counts, stringent=True))


@query(
    "agg12_power_only",
    f"""select * exclude (False_Discovery), Detected_CV + CV_Not_Significant_In_Interval as Detected,
               Detected_CV + CV_Not_Significant_In_Interval + Missed_CV as Simulated,
               case when Detected_CV + CV_Not_Significant_In_Interval + Missed_CV = 0 then cast(0 as double)
                    else {rnd('(Detected_CV + CV_Not_Significant_In_Interval) / (Detected_CV + CV_Not_Significant_In_Interval + Missed_CV)')} end as Power
        from c_counts""",
)
def _(d):
    counts = P.count_outcomes(P.designate(stored_assessment(d)), (*P.CELL, "threshold"))
    return rounded(P.power_only(counts))


@query(
    "pip06_performance",
    f"""select *, case when Simulated = 0 then cast(0 as double)
                       else {rnd('(Detected_CV + CV_Not_Significant_In_Interval) / Simulated')} end as Power,
               case when Detected = 0 then cast(0 as double) else {rnd('False_Discovery / Detected')} end as FDR
        from (select *, {_COUNTS} from c_counts) z""",
)
def _(d):
    return rounded(P.performance(stored_assessment(d)))
