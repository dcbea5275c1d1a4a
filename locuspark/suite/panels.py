"""Variant and genotype jobs, the older path, and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.operators import genotype as G
from locuspark.operators import legacy as L
from locuspark.operators import linkage
from locuspark.operators.intervals import ensure_position, flag_significant
from locuspark.plans import legacy as LP
from locuspark.plans.marker_set import build_marker_set
from locuspark.session import scratch_dir
from locuspark.streaming import (
    read_ingested,
    read_ledger,
    read_replication,
    stream_ingest,
    stream_ledger,
    stream_replication,
)
from locuspark.suite.assessment import rounded
from locuspark.suite.domain import ALPHA, CI_SIZE, SNP_GROUPING, Domain
from locuspark.suite.files import strain_names, vcf_file
from locuspark.suite.oracle import log10p, rnd
from locuspark.suite.registry import query

_CALLS = """select v.CHROM, v.POS, v.ID, v.REF, v.ALT, concat('S', cast(c.nk as varchar)) as strain,
   case when code < 6 then '0/0' when code < 11 then '1|1' when code = 11 then '0/1' else './.' end as gt
   from d_calls c join d_variants v on v.pk = c.pk"""


def calls(d: Domain) -> DataFrame:
    gt = F.expr(
        "case when code < 6 then '0/0' when code < 11 then '1|1' when code = 11 then '0/1' else './.' end"
    )
    return (
        d.table("d_calls")
        .select("pk", F.concat(F.lit("S"), "nk").alias("strain"), gt.alias("gt"))
        .join(d.table("d_variants"), "pk")
        .drop("pk")
    )


@query(
    "fil06_subset_samples",
    f"""with k as ({_CALLS}), s as (select * from k where strain in (
          select concat('S', n_nationkey) from nation where n_regionkey < 2))
        select * from s where not exists (select 1 from s h where h.CHROM = s.CHROM and h.POS = s.POS and h.gt = './.')""",
)
def _(d):
    samples = d.source("nation").where("n_regionkey < 2").select(
        F.concat(F.lit("S"), "n_nationkey").alias("strain")
    )
    return G.subset_samples(calls(d), samples)


@query(
    "fil07_variant_qc",
    f"""with k as ({_CALLS}), q as (
          select CHROM, POS, ID, REF, ALT, count(*) filter (gt = './.') / count(*) as missing_rate,
                 avg(case gt when '0/0' then 0.0 when '1|1' then 2.0 when '0/1' then 1.0 end) / 2 as f
          from k where length(REF) = 1 and length(ALT) = 1 and CHROM <> 'MtDNA'
          group by CHROM, POS, ID, REF, ALT)
        select CHROM, POS, case when ID = '.' then concat(CHROM, ':', POS) else ID end as ID, REF, ALT,
               {rnd('missing_rate')} as missing_rate, {rnd('least(f, 1 - f)')} as maf
        from q where missing_rate <= 0.1 and least(f, 1 - f) >= 0.2""",
)
def _(d):
    return rounded(G.variant_qc(calls(d), 0.2, drop_chrom="MtDNA"))


@query(
    "fil08_keep_markers",
    """select g.* from genotypes g where exists (select 1 from markers k where k.marker_set_id = g.marker_set_id
         and k.CHROM = g.CHROM and k.POS = g.POS and k.A1 = 'A')""",
)
def _(d):
    return G.keep_markers(d.genotypes, d.markers.where(F.col("A1") == "A"))


@query(
    "fil09_complete_markers",
    """select g.* from genotypes g
       join (select marker_set_id, CHROM, POS from genotypes group by marker_set_id, CHROM, POS having count(allele) = count(*)) h
         on h.marker_set_id = g.marker_set_id and h.CHROM = g.CHROM and h.POS = g.POS""",
)
def _(d):
    return G.complete_markers(d.genotypes)


@query(
    "agg13_allele_frequency",
    f"""select marker_set_id, CHROM, POS, {rnd('af')} as af from (
          select marker_set_id, CHROM, POS, count(*) filter (allele = 1) / count(*) as af
          from genotypes group by marker_set_id, CHROM, POS) z where af >= 0.05 and af <= 0.95""",
)
def _(d):
    return rounded(G.allele_frequency(d.genotypes))


@query(
    "joi17_region_join",
    """select k.marker_set_id, k.marker, k.CHROM, k.POS, b.s as "start", b.e as "end" from markers k
       join (select cast(s_suppkey % 6 + 1 as varchar) as c, s_suppkey * 20000 as s,
                    s_suppkey * 20000 + cast(floor(abs(s_acctbal)) as bigint) * 10 as e from supplier) b
         on b.c = k.CHROM and k.POS >= b.s and k.POS <= b.e""",
)
def _(d):
    bed = d.source("supplier").select(
        (F.col("s_suppkey") % 6 + 1).alias("chrom"),
        (F.col("s_suppkey") * 20000).alias("start"),
        (F.col("s_suppkey") * 20000 + F.floor(F.abs("s_acctbal")) * 10).alias("end"),
    )
    variants = d.markers.select("marker_set_id", "marker", "CHROM", "POS")
    return G.region_join(variants, bed)


def dense(d: Domain) -> DataFrame:
    """The variant table with every strain typed: cells without a call count as reference."""
    names = strain_names(d)
    allele = F.when(F.col("code").between(6, 10), 1.0).otherwise(-1.0)
    wide = (
        d.table("d_calls")
        .select("pk", F.concat(F.lit("S"), "nk").alias("strain"), allele.alias("allele"))
        .groupBy("pk")
        .pivot("strain", names)
        .agg(F.first("allele"))
        .join(d.table("d_variants").select("pk", "CHROM", "POS"), "pk")
        .drop("pk")
        .fillna(-1.0, names)
    )
    return G.melt_genotypes(wide).withColumn("marker_set_id", F.lit("dense"))


_DENSE = """select v.CHROM, v.POS, n.n_nationkey as strain, case when c.code between 6 and 10 then 1.0 else -1.0 end::double as x,
     least(avg(case when c.code between 6 and 10 then 1.0 else 0.0 end) over (partition by v.pk),
           1 - avg(case when c.code between 6 and 10 then 1.0 else 0.0 end) over (partition by v.pk)) as maf
   from d_variants v join (select distinct pk from d_calls) y on y.pk = v.pk
   cross join nation n left join d_calls c on c.pk = v.pk and c.nk = n.n_nationkey"""


@query(
    "agg14_gram",
    f"""with k as ({_DENSE}), z as (
          select CHROM, POS, strain, (x - avg(x) over w) / sqrt(var_pop(x) over w * count(*) over w) as z
          from k where maf >= 0.05 window w as (partition by CHROM, POS)),
        o as (select n_nationkey as strain, cast(row_number() over (order by concat('S', n_nationkey)) - 1 as int) as i from nation),
        p as (select z.*, o.i from z join o on o.strain = z.strain)
        select 'dense' as marker_set_id, a.CHROM, a.i, b.i as j, {rnd('sum(a.z * b.z)', 6)} as v
        from p a join p b on b.CHROM = a.CHROM and b.POS = a.POS and b.i >= a.i group by a.CHROM, a.i, b.i""",
)
def _(d):
    return rounded(linkage.gram_cells(linkage.gram_tiles(dense(d))), 6)


@query("agg14_independent_tests")
def _(d):
    return rounded(linkage.total_independent_tests(linkage.independent_tests(dense(d))), 6)


@query(
    "agg15_ld_pairs",
    f"""with o as (select marker_set_id, CHROM, POS, row_number() over (partition by marker_set_id, CHROM order by POS) - 1 as i
                  from (select distinct marker_set_id, CHROM, POS from genotypes) z),
        g as (select o.*, x.strain, x.allele from o join genotypes x on x.marker_set_id = o.marker_set_id
              and x.CHROM = o.CHROM and x.POS = o.POS),
        p as (select a.marker_set_id, a.CHROM, a.i, b.i as j, a.POS as pos_a, b.POS as pos_b
              from o a join o b on b.marker_set_id = a.marker_set_id and b.CHROM = a.CHROM and b.i > a.i and b.i < a.i + 50),
        s as (select a.marker_set_id, a.CHROM, a.i, b.i as j, count(*) as n, sum(a.allele) as sa, sum(b.allele) as sb,
                     sum(a.allele * a.allele) as saa, sum(b.allele * b.allele) as sbb, sum(a.allele * b.allele) as sab
              from g a join g b on b.marker_set_id = a.marker_set_id and b.CHROM = a.CHROM and b.strain = a.strain
               and b.i > a.i and b.i < a.i + 50
              where a.allele is not null and b.allele is not null
              group by a.marker_set_id, a.CHROM, a.i, b.i)
        select p.marker_set_id, p.CHROM, p.pos_a, p.pos_b,
          case when (n * saa - sa * sa) * (n * sbb - sb * sb) > 0
               then {rnd('(n * sab - sa * sb) * (n * sab - sa * sb) / ((n * saa - sa * sa) * (n * sbb - sb * sb))')} end as r2
        from p left join s on s.marker_set_id = p.marker_set_id and s.CHROM = p.CHROM and s.i = p.i and s.j = p.j""",
)
def _(d):
    return rounded(linkage.ld_pairs(d.genotypes).drop("i", "j"))


def _prune_sql(typed: str, limit: float) -> str:
    """CTEs up to ``gone`` (CHROM, POS): greedy elimination over typed(CHROM, POS, strain, x, maf), x known everywhere."""
    return f"""k as ({typed}),
        o as (select CHROM, POS, maf, row_number() over (partition by CHROM order by POS) - 1 as i
              from (select distinct CHROM, POS, maf from k) z),
        g as (select o.*, k.strain, k.x from o join k on k.CHROM = o.CHROM and k.POS = o.POS),
        s as (select a.CHROM, a.i, b.i as j, a.POS as pa, b.POS as pb, a.maf as ma, b.maf as mb, count(*) as n,
                     sum(a.x) as sa, sum(b.x) as sb, sum(a.x * a.x) as saa, sum(b.x * b.x) as sbb, sum(a.x * b.x) as sab
              from g a join g b on b.CHROM = a.CHROM and b.strain = a.strain and b.i > a.i and b.i < (a.i // 10) * 10 + 50
              group by all),
        e as materialized (
              select CHROM, case when ma < mb then i else j end as l, case when ma < mb then j else i end as w,
                     case when ma < mb then pa else pb end as POS,
                     (greatest(ceil((j - 49) / 10.0), 0) * 1000000000 + i) * 1000 + (j - i) as t
              from s where (n * saa - sa * sa) * (n * sbb - sb * sb) > 0
                and (n * sab - sa * sb) * (n * sab - sa * sb) / ((n * saa - sa * sa) * (n * sbb - sb * sb)) > {limit}),
        r as (select *, false as fired from e
              union all
              (with f as (select CHROM, l, min(t) as t from r where not fired group by CHROM, l),
                    x as (select r.CHROM, r.l, r.w, r.POS, r.t, r.t = a.t and (b.t is null or r.t < b.t) as fired
                          from r join f a on a.CHROM = r.CHROM and a.l = r.l left join f b on b.CHROM = r.CHROM and b.l = r.w
                          where not r.fired)
               select x.CHROM, x.l, x.w, x.POS, x.t, x.fired from x
               left join x c on c.fired and c.CHROM = x.CHROM and c.l = x.l left join x d on d.fired and d.CHROM = x.CHROM and d.l = x.w
               where x.fired or ((c.t is null or x.t < c.t) and (d.t is null or x.t < d.t)))),
        gone as (select CHROM, POS from r where fired)"""


@query(
    "agg15_ld_prune",
    f"with recursive {_prune_sql(_DENSE, 0.5)} select 'dense' as marker_set_id, CHROM, POS from gone",
)
def _(d):
    genotypes = dense(d)
    return linkage.ld_prune(
        linkage.ld_pairs(genotypes), G.allele_frequency(genotypes, low=None), 0.5
    )


# Five strains, called everywhere; the order of contigs in the header gives the chromosome numbers.
_BUILD = """select case v.CHROM when 'I' then '1' when 'II' then '2' when 'III' then '3' when 'IV' then '4' when 'V' then '5' else '6' end as CHROM,
     v.POS, strain, x, least(f, 1 - f) as maf
   from (select v.CHROM, v.POS, concat('S', n.n_nationkey) as strain,
                case when c.code < 6 then 0.0 when c.code < 11 then 2.0 when c.code = 11 then 1.0 end::double as x,
                avg(case when c.code < 6 then 0.0 when c.code < 11 then 2.0 when c.code = 11 then 1.0 end) over (partition by v.pk) / 2 as f,
                count(*) filter (c.code is null or c.code > 11) over (partition by v.pk) as holes
         from d_variants v join nation n on n.n_regionkey = 0 left join d_calls c on c.pk = v.pk and c.nk = n.n_nationkey
         where v.CHROM <> 'MtDNA' and length(v.REF) = 1 and length(v.ALT) = 1 and v.ALT not in ('.', '*')) v
   where holes = 0 and least(f, 1 - f) >= 0.05"""


@query(
    "pip12_marker_set_build",
    f"""with recursive {_prune_sql(_BUILD, 0.8)} select 'built' as marker_set_id, k.CHROM, k.POS, k.strain,
          case k.x when 0 then -1.0 when 2 then 1.0 end::double as allele
        from k where not exists (select 1 from gone where gone.CHROM = k.CHROM and gone.POS = k.POS)""",
)
def _(d):
    samples = d.source("nation").where("n_regionkey = 0").select(
        F.concat(F.lit("S"), "n_nationkey").alias("strain")
    )
    _markers, genotypes = build_marker_set(d.spark, vcf_file(d), samples, "built", 0.05, 0.8)
    return genotypes


# ---- older path -----------------------------------------------------------

_L = f"""l1 as (select s.mapping_id, s.marker, split_part(s.marker, ':', 1) as CHROM,
     cast(split_part(s.marker, ':', 2) as int) as POS, s.AF1, s.BETA, {log10p('s.P')} as lp
   from mappings s where {log10p('s.P')} <> 0),
 l2 as (select mapping_id, -log10({ALPHA} / count(*) filter (lp > 0)) as thr from l1 group by mapping_id),
 l3 as (select l1.*, l2.thr, cast(lp >= thr as int) as sig,
     row_number() over (partition by l1.mapping_id, CHROM order by POS) as idx,
     count(*) over (partition by l1.mapping_id, CHROM) as nc from l1 join l2 on l2.mapping_id = l1.mapping_id)"""


@query(
    "fil11_drop_zero",
    f"with {_L} select mapping_id, marker, {rnd('lp')} as log10p from l1",
)
def _(d):
    return rounded(L.scored(d.mappings).select("mapping_id", "marker", "log10p"))


def flagged(d: Domain) -> DataFrame:
    rows = ensure_position(L.scored(d.mappings))
    return flag_significant(rows, L.legacy_thresholds(rows, "BF", ALPHA))


@query(
    "win08_running_significant",
    f"""with {_L} select mapping_id, marker, cast(idx as int) as "index",
          cast(sum(sig) over (partition by mapping_id, CHROM order by POS) as bigint) as peaks,
          cast(sum(sig) over (partition by mapping_id, CHROM) as bigint) as nBF from l3""",
)
def _(d):
    return L.running_significant(flagged(d)).select("mapping_id", "marker", "index", "peaks", "nBF")


def _older(max_share: float) -> str:
    return f"""{_L},
 l4 as (select mapping_id from l3 group by mapping_id having sum(sig) > 0 and sum(sig) < count(*) * {max_share}),
 l5 as (select *, case when lag(CHROM) over w = CHROM and idx - lag(idx) over w < {SNP_GROUPING} then 0 else 1 end as brk
        from l3 where sig = 1 and mapping_id in (select mapping_id from l4)
        window w as (partition by mapping_id order by CHROM, idx)),
 l6 as (select *, cast(sum(brk) over (partition by mapping_id order by CHROM, idx) as int) as peak_id from l5),
 l7 as (select * from (select *, row_number() over (partition by mapping_id, peak_id order by lp desc, POS) as rn,
          greatest(min(idx) over (partition by mapping_id, peak_id) - {CI_SIZE}, 1) as lo,
          least(max(idx) over (partition by mapping_id, peak_id) + {CI_SIZE}, nc) as hi from l6) z where rn = 1),
 l8 as (select t.mapping_id, t.marker, t.peak_id, t.POS as peakPOS, a.POS as startPOS, b.POS as endPOS
        from l7 t join l3 a on a.mapping_id = t.mapping_id and a.CHROM = t.CHROM and a.idx = t.lo
        join l3 b on b.mapping_id = t.mapping_id and b.CHROM = t.CHROM and b.idx = t.hi),
 gc as (select g.* from genotypes g where not exists (select 1 from genotypes h where h.marker_set_id = g.marker_set_id
          and h.CHROM = g.CHROM and h.POS = g.POS and h.allele is null)),
 l9 as (select x.mapping_id, x.marker, p.strain, p.phenotype as value, g.allele from l6 x
        join metadata m on m.mapping_id = x.mapping_id join phenotypes p on p.trait_id = m.trait_id
        left join gc g on g.marker_set_id = m.marker_set_id and g.CHROM = x.CHROM and g.POS = x.POS and g.strain = p.strain),
 ve as (select mapping_id, marker, covar_pop(value, allele) as c,
          var_pop(case when allele is not null then value end) as vy, var_pop(allele) as va from l9 group by mapping_id, marker),
 lout as (select l3.mapping_id, l3.marker, l3.CHROM, l3.POS, l3.AF1, l3.BETA, l3.lp, l3.thr, l3.sig, l9.strain, l9.value, l9.allele,
          case when ve.vy * ve.va > 0 then ve.c * ve.c / (ve.vy * ve.va) end as var_exp,
          l8.startPOS, l8.peakPOS, l8.endPOS, l8.peak_id, l8.endPOS - l8.startPOS as interval_size
        from l3 left join l9 on l9.mapping_id = l3.mapping_id and l9.marker = l3.marker
        left join ve on ve.mapping_id = l3.mapping_id and ve.marker = l3.marker
        left join l8 on l8.mapping_id = l3.mapping_id and l8.marker = l3.marker)"""


def older_intervals(d: Domain, max_share: float = L.MAX_SHARE) -> DataFrame:
    return LP.legacy_intervals(
        d.mappings,
        d.metadata,
        d.genotypes,
        d.phenotypes,
        "BF",
        ALPHA,
        CI_SIZE,
        SNP_GROUPING,
        max_share,
    )


_LOUT = f"""select mapping_id, marker, CHROM, POS, {rnd('lp')} as log10p, {rnd('thr')} as BF, sig as aboveBF, strain,
   {rnd('value')} as value, allele, {rnd('var_exp', 8)} as var_exp, startPOS, peakPOS, endPOS, peak_id, interval_size from lout"""


def _shown(df: DataFrame) -> DataFrame:
    return rounded(df.drop("population", "AF1", "BETA", "SE", "P"), var_exp=8)


@query("pip09_legacy_intervals", f"with {_older(0.15)} {_LOUT}")
def _(d):
    return _shown(older_intervals(d))


@query("pip09_legacy_intervals_guarded", f"with {_older(0.04)} {_LOUT}")
def _(d):
    return _shown(older_intervals(d, 0.04))


@query(
    "pip10_legacy_assessment",
    f"""with {_older(0.15)},
 e1 as (select c.trait_id, c.QTL, covar_pop(p.phenotype, g.allele) as c,
          var_pop(case when g.allele is not null then p.phenotype end) as vy, var_pop(g.allele) as va
        from causal_variants c join traits t on t.trait_id = c.trait_id
        join genotypes g on g.marker_set_id = t.marker_set_id and g.CHROM = c.CHROM and g.POS = c.POS
        join phenotypes p on p.trait_id = c.trait_id and p.strain = g.strain group by c.trait_id, c.QTL),
 e2 as (select m.mapping_id, c.QTL, c.CHROM, c.POS, c.RefAllele, c.Frequency, c.Effect,
          case when vy * va > 0 then e1.c * e1.c / (vy * va) end as sim_ve, r.lp, r.sig
        from metadata m join causal_variants c on c.trait_id = m.trait_id
        join l3 r on r.mapping_id = m.mapping_id and r.marker = c.QTL
        left join e1 on e1.trait_id = c.trait_id and e1.QTL = c.QTL),
 e3 as (select distinct mapping_id, CHROM, marker, BETA, lp, var_exp, AF1, startPOS, peakPOS, endPOS, peak_id, interval_size
        from lout where peak_id is not null),
 e4 as (select p.*, coalesce(s.QTL, p.marker) as QTL from e3 p left join e2 s on s.mapping_id = p.mapping_id
          and s.CHROM = p.CHROM and s.POS >= p.startPOS and s.POS <= p.endPOS)
 select coalesce(a.mapping_id, b.mapping_id) as mapping_id, coalesce(a.QTL, b.QTL) as QTL, a.CHROM, a.POS, a.RefAllele,
   {rnd('a.Frequency')} as Frequency, {rnd('a.Effect')} as Effect, {rnd('a.sim_ve', 8)} as Simulated_QTL_VarExp,
   {rnd('a.lp')} as log10p, a.sig as significant, b.peak_id, b.marker as detected_peak, {rnd('b.BETA')} as BETA,
   {rnd('b.lp')} as interval_log10p, {rnd('b.var_exp', 8)} as interval_var_exp, {rnd('b.AF1')} as interval_Frequency,
   b.startPOS, b.peakPOS, b.endPOS, b.interval_size, a.QTL is not null as Simulated, b.peak_id is not null as Detected,
   coalesce(a.QTL, b.QTL) = b.marker as top_hit
 from e2 a full join e4 b on b.mapping_id = a.mapping_id and b.QTL = a.QTL""",
)
def _(d):
    intervals = d.staged("legacy", lambda: older_intervals(d))
    out = LP.legacy_assessment(
        intervals, d.metadata, d.causal_variants, d.genotypes, d.phenotypes, d.traits
    )
    return rounded(out, Simulated_QTL_VarExp=8, interval_var_exp=8)


# ---- streaming ------------------------------------------------------------


@query(
    "str01_stream_ingest",
    f"""select population, mapping_id, marker, {rnd('case when population = ' + "'ce.panel'" + ' then BETA + 1 else BETA end')} as BETA
        from mappings where population <> 'ce.panel' or (cast(split_part(marker, ':', 2) as int) // 1000) % 3 <> 0""",
)
def _(d):
    """Every mapping comes in two parts; one population is run again with fewer markers, and parts of its first run come late."""
    arriving, base = scratch_dir(d.spark, "arriving"), scratch_dir(d.spark, "database")
    checkpoint = scratch_dir(d.spark, "checkpoint")
    number = F.floor(F.substring_index("marker", ":", -1).cast("int") / 1000)
    rows = d.mappings.select("population", "mapping_id", "marker", "AF1", "BETA", "SE", "P").withColumn("run", F.lit(1))
    again = rows.where((F.col("population") == "ce.panel") & (number % 3 != 0))
    again = again.withColumns({"BETA": F.col("BETA") + 1, "run": F.lit(2)})
    late = rows.where(F.col("population") == "ce.panel").withColumn("BETA", F.lit(0.0))
    for part in (rows.where(number % 2 == 0), rows.where(number % 2 == 1), again, late):
        part.write.mode("append").parquet(arriving)
        stream_ingest(d.spark, arriving, base, checkpoint).awaitTermination()
    return rounded(read_ingested(d.spark, base).select("population", "mapping_id", "marker", "BETA"))


@query(
    "str02_stream_ledger",
    """select species, grp, nqtl, effect, h2, rep, mode, type, attempt, task_hash, exit_code from (
         select *, row_number() over (partition by species, grp, nqtl, effect, h2, rep, mode, type order by attempt desc) as rn
         from outcomes) z where rn = 1 and exit_code <> 0""",
)
def _(d):
    arriving, base = scratch_dir(d.spark, "arriving"), scratch_dir(d.spark, "ledger")
    checkpoint = scratch_dir(d.spark, "checkpoint")
    late = F.col("session") == "this_run"
    for part in (d.outcomes.where(late), d.outcomes.where(~late)):
        part.write.mode("append").parquet(arriving)
        events = d.spark.readStream.schema(part.schema).parquet(arriving)
        stream_ledger(events, base, checkpoint).awaitTermination()
    return read_ledger(d.spark, base).select(
        "species", "grp", "nqtl", "effect", "h2", "rep", "mode", "type", "attempt", "task_hash", "exit_code"
    )


@query(
    "str03_stream_replication",
    """select population, maf, nqtl, effect, h2, algorithm, pca, count(distinct rep) as n_reps,
              count(distinct rep) >= 4 as complete
       from metadata group by population, maf, nqtl, effect, h2, algorithm, pca""",
)
def _(d):
    arriving, base = scratch_dir(d.spark, "arriving"), scratch_dir(d.spark, "replication")
    checkpoint = scratch_dir(d.spark, "checkpoint")
    early = F.col("rep") <= 2
    for part in (d.metadata.where(early), d.metadata.where(F.col("rep") >= 2)):
        part.write.mode("append").parquet(arriving)
        rows = d.spark.readStream.schema(part.schema).parquet(arriving)
        stream_replication(rows, base, checkpoint).awaitTermination()
    return read_replication(d.spark, base, 4)
