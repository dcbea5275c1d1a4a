"""Two assessment runs side by side, raw against stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions import interval_jaccard
from locuspark.operators import compare as K
from locuspark.operators import sets
from locuspark.suite.assessment import rounded, stored_assessment
from locuspark.suite.domain import Domain
from locuspark.suite.oracle import rnd
from locuspark.suite.registry import query

# The second run: the same assessment with some detections and borders changed.
_CHANGED = {
    "Detected": "Detected and not (top_hit and interval_size < 5000)",
    "startPOS": "case when peak_id >= 3 then startPOS - 700 else startPOS end",
    "endPOS": "case when CHROM = '2' then endPOS + 1300 else endPOS end",
}


def runs(d: Domain) -> tuple[DataFrame, DataFrame]:
    first = stored_assessment(d)
    return first, first.withColumns({c: F.expr(e) for c, e in _CHANGED.items()})


def pairs(d: Domain) -> DataFrame:
    return K.pair_assessments(*runs(d))


_DESIG = """case when Simulated and Detected and (significant = 1 or significant is null) then 'Detected.CV'
      when Simulated and not Detected and (significant = 0 or significant is null) then 'Missed.CV'
      when Simulated and Detected and significant = 0 then 'CV.Not.Significant.In.Interval'
      when not Simulated and Detected then 'False.Discovery' end"""
_KEY = "nQTL, simREP, h2, maf, effect_distribution, strain_set_id, norm_alg, QTL"
_PAIRS = f"""p1 as (select *, upper(algorithm_id) as norm_alg from c_assess),
 p2 as (select * replace ({', '.join(f'({e}) as {c}' for c, e in _CHANGED.items())}) from p1),
 p3 as (select a.nQTL, a.simREP, a.h2, a.maf, a.effect_distribution, a.strain_set_id, a.norm_alg, a.QTL,
   a.Detected as Detected_a, a.desig as designation_a, a.startPOS as startPOS_a, a.endPOS as endPOS_a,
   b.Detected as Detected_b, b.desig as designation_b, b.startPOS as startPOS_b, b.endPOS as endPOS_b
  from (select *, {_DESIG} as desig from p1) a join (select *, {_DESIG} as desig from p2) b using ({_KEY}))"""
_GROUP = "nQTL, simREP, h2, maf, strain_set_id, norm_alg"
_JAC = """case when greatest(endPOS_a, endPOS_b) - least(startPOS_a, startPOS_b) = 0 then 1.0
   else greatest(0, least(endPOS_a, endPOS_b) - greatest(startPOS_a, startPOS_b))
        / (greatest(endPOS_a, endPOS_b) - least(startPOS_a, startPOS_b)) end"""


@query("joi19_pair_assessments", f"with {_PAIRS} select * from p3")
def _(d):
    return pairs(d)


@query(
    "sca17_interval_jaccard",
    f"with {_PAIRS} select {_KEY}, {rnd(_JAC)} as jaccard from p3 where startPOS_a is not null",
)
def _(d):
    score = interval_jaccard(*[F.col(c) for c in ("startPOS_a", "endPOS_a", "startPOS_b", "endPOS_b")])
    return rounded(
        pairs(d).where(F.col("startPOS_a").isNotNull()).select(*K.PAIR_KEY, score.alias("jaccard"))
    )


def _agree(column: str, name: str, where: str = "true") -> str:
    return f"""with {_PAIRS} select {_GROUP}, count(*) as n_qtl,
      count(*) filter ({column}_a = {column}_b) as n_agree,
      {rnd(f'avg(case when {column}_a = {column}_b then 1.0 else 0.0 end)')} as {name}
      from p3 where {where} group by {_GROUP}"""


@query("agg30_detection_concordance", _agree("Detected", "detection_concordance"))
def _(d):
    return rounded(K.detection_concordance(pairs(d)))


@query(
    "agg31_designation_concordance",
    _agree(
        "designation",
        "designation_concordance",
        "designation_a is not null and designation_b is not null",
    ),
)
def _(d):
    return rounded(K.designation_concordance(pairs(d)))


_INTERVALS = f"""select {_GROUP}, count(*) as n_intervals, count(*) filter (({_JAC}) = 1) as n_perfect,
   {rnd(f'avg({_JAC})')} as interval_concordance from p3
   where Detected_a and Detected_b and startPOS_a is not null and endPOS_a is not null
     and startPOS_b is not null and endPOS_b is not null group by {_GROUP}"""


@query("agg32_interval_concordance", f"with {_PAIRS} {_INTERVALS}")
def _(d):
    return rounded(K.interval_concordance(pairs(d)))


@query(
    "pip11_compare_assessments",
    f"""with {_PAIRS} select a.strain_set_id, a.n_qtl, {rnd('a.dc')} as detection_concordance,
          {rnd('b.gc')} as designation_concordance, c.n_intervals, {rnd('c.ic')} as interval_concordance
        from (select strain_set_id, count(*) as n_qtl, avg(case when Detected_a = Detected_b then 1.0 else 0.0 end) as dc
              from p3 group by strain_set_id) a
        left join (select strain_set_id, avg(case when designation_a = designation_b then 1.0 else 0.0 end) as gc
              from p3 where designation_a is not null and designation_b is not null group by strain_set_id) b
          using (strain_set_id)
        left join (select strain_set_id, count(*) as n_intervals, avg({_JAC}) as ic from p3
              where Detected_a and Detected_b and startPOS_a is not null and endPOS_a is not null
                and startPOS_b is not null and endPOS_b is not null group by strain_set_id) c using (strain_set_id)""",
)
def _(d):
    return rounded(K.compare_assessments(pairs(d), ["strain_set_id"]))


@query(
    "joi20_roundtrip_diff",
    f"""select mapping_id, marker, {rnd('b1')} as BETA_raw, {rnd('b2')} as BETA_stored,
               case when marker2 is null then 'only_raw' when marker1 is null then 'only_stored' else 'value' end as problem
        from (select coalesce(a.mapping_id, b.mapping_id) as mapping_id, coalesce(a.marker, b.marker) as marker,
                     a.marker as marker1, b.marker as marker2, a.BETA as b1, b.BETA as b2
              from (select * from mappings where SE < 0.175) a
              full join (select mapping_id, marker, case when AF1 > 0.9 then BETA + 0.5 else BETA end as BETA
                         from mappings where SE > 0.105) b
                on a.mapping_id = b.mapping_id and a.marker = b.marker) z
        where marker1 is null or marker2 is null or abs(b1 - b2) > 1e-12""",
)
def _(d):
    raw = d.mappings.where("SE < 0.175")
    stored = d.mappings.where("SE > 0.105").withColumn(
        "BETA", F.expr("case when AF1 > 0.9 then BETA + 0.5 else BETA end")
    )
    return rounded(K.roundtrip_diff(raw, stored, ["BETA"]))


@query(
    "set08_concat_assessments",
    """select QTL, Simulated, Detected, mode, type, threshold, strain_set_id from c_assess
       union all select QTL, Simulated, Detected and not (top_hit and interval_size < 5000), mode, type, threshold,
                        strain_set_id from c_assess""",
)
def _(d):
    return sets.concat_assessments(runs(d)).select(
        "QTL", "Simulated", "Detected", "mode", "type", "threshold", "strain_set_id"
    )
