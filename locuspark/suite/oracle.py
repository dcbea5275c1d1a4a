"""SQL texts for the analysis chain, written independently of the operators.

They use plain windows over whole mappings, which is fine at oracle scale and
checks the block-wise operators against the textbook form.
"""

from __future__ import annotations

ALPHA = 0.05
CI_SIZE = 3
SNP_GROUPING = 5


def rnd(expr: str, digits: int = 9) -> str:
    """Rounded double without a negative zero."""
    return f"(case when ({expr}) = 0 then cast(0 as double) else round({expr}, {digits}) end)"


def log10p(p: str = "P") -> str:
    return f"(case when {p} = 0 then cast(300 as double) else -log10({p}) end)"


def oracle_tables() -> dict[str, str]:
    out: dict[str, str] = {}
    out["a_thr"] = f"""
select mapping_id, 'BF' as method, -log10({ALPHA} / count(*)) as thr from mappings group by mapping_id
union all
select m.mapping_id, 'EIGEN', -log10({ALPHA} / s.n_independent_tests)
from metadata m join marker_set_metadata s on s.marker_set_id = m.marker_set_id
where s.n_independent_tests > 0"""
    out["a_flag"] = f"""
select m.mapping_id, t.method, t.thr, m.marker, split_part(m.marker, ':', 1) as CHROM,
       cast(split_part(m.marker, ':', 2) as int) as POS, m.AF1, m.BETA, m.SE, m.P,
       {log10p('m.P')} as log10p,
       cast({log10p('m.P')} >= t.thr as int) as significant
from mappings m join a_thr t on t.mapping_id = m.mapping_id"""
    out["a_idx"] = """
select *, row_number() over (partition by mapping_id, method, CHROM order by POS, marker) as idx,
       count(*) over (partition by mapping_id, method, CHROM) as n_chrom
from a_flag"""
    out["a_brk"] = f"""
select *, case when lag(CHROM) over w = CHROM and idx - lag(idx) over w < {SNP_GROUPING}
               then 0 else 1 end as brk
from a_idx where significant = 1
window w as (partition by mapping_id, method order by CHROM, idx)"""
    out["a_peaked"] = """
select *, cast(sum(brk) over (partition by mapping_id, method order by CHROM, idx) as int) as peak_id
from a_brk"""
    out["a_top"] = """
select * from (
  select *, row_number() over (partition by mapping_id, method, peak_id
                               order by log10p desc, POS) as rn
  from a_peaked) z where rn = 1"""
    out["a_range"] = f"""
select mapping_id, method, peak_id, CHROM, greatest(min(idx) - {CI_SIZE}, 1) as lo,
       least(max(idx) + {CI_SIZE}, max(n_chrom)) as hi, count(*) as n_sig
from a_peaked group by mapping_id, method, peak_id, CHROM"""
    out["a_peaks"] = """
select r.mapping_id, r.method, r.peak_id, r.CHROM, a.POS as startPOS, t.POS as peakPOS,
       b.POS as endPOS, b.POS - a.POS as interval_size, r.n_sig, t.log10p as max_log10p,
       t.marker as peak_marker, t.thr, t.AF1 as peak_AF1, t.BETA as peak_BETA
from a_range r
join a_idx a on a.mapping_id = r.mapping_id and a.method = r.method and a.CHROM = r.CHROM and a.idx = r.lo
join a_idx b on b.mapping_id = r.mapping_id and b.method = r.method and b.CHROM = r.CHROM and b.idx = r.hi
join a_top t on t.mapping_id = r.mapping_id and t.method = r.method and t.peak_id = r.peak_id"""
    out["a_analyzed"] = """
select f.*, k.peak_id, p.startPOS, p.peakPOS, p.endPOS, p.interval_size
from a_flag f
left join a_peaked k on k.mapping_id = f.mapping_id and k.method = f.method and k.marker = f.marker
left join a_peaks p on p.mapping_id = f.mapping_id and p.method = f.method and p.peak_id = k.peak_id"""
    out["v_pos"] = "select distinct trait_id, QTL, CHROM, POS from causal_variants"
    out["v_merged"] = """
select p.trait_id, p.QTL, p.CHROM, p.POS, g.strain, g.allele
from v_pos p join causal_genotypes g on g.trait_id = p.trait_id and g.CHROM = p.CHROM and g.POS = p.POS
union all
select p.trait_id, p.QTL, p.CHROM, p.POS, g.strain, g.allele
from v_pos p join traits t on t.trait_id = p.trait_id
join genotypes g on g.marker_set_id = t.marker_set_id and g.CHROM = p.CHROM and g.POS = p.POS
left join (select distinct trait_id, CHROM, POS from causal_genotypes) c
  on c.trait_id = p.trait_id and c.CHROM = p.CHROM and c.POS = p.POS
where c.trait_id is null"""
    out["v_joined"] = """
select m.trait_id, m.QTL, m.strain, m.allele, p.phenotype
from v_merged m join phenotypes p on p.trait_id = m.trait_id and p.strain = m.strain"""
    out["v_class"] = """
select trait_id, QTL, allele, count(*) as n, avg(phenotype) as mean_y, var_pop(phenotype) as v
from v_joined where allele is not null group by trait_id, QTL, allele"""
    out["v_stat"] = """
select c.trait_id, c.QTL, count(*) as k, min(c.n) as least, sum(c.n * c.v) as within_ss,
       sum(c.n * (c.mean_y - g.m) * (c.mean_y - g.m)) as between_ss
from v_class c join (select trait_id, QTL, avg(phenotype) as m from v_joined
                     where allele is not null group by trait_id, QTL) g
  on g.trait_id = c.trait_id and g.QTL = c.QTL
group by c.trait_id, c.QTL"""
    out["v_exp"] = """
select d.trait_id, d.QTL,
       case when k >= 2 and least >= 2 and between_ss + within_ss > 0
            then between_ss / (between_ss + within_ss) end as ve
from (select distinct trait_id, QTL from v_joined) d
left join v_stat s on s.trait_id = d.trait_id and s.QTL = d.QTL"""
    out["c_scored"] = """
select m.mapping_id, t.method, t.thr, c.trait_id, c.QTL, c.CHROM, c.POS, c.RefAllele, c.Frequency, c.Effect,
       f.log10p, f.significant
from metadata m join causal_variants c on c.trait_id = m.trait_id
join a_thr t on t.mapping_id = m.mapping_id
left join a_flag f on f.mapping_id = m.mapping_id and f.method = t.method and f.marker = c.QTL"""
    out["c_overlap"] = """
select p.*, s.QTL, s.POS, s.RefAllele, s.Frequency, s.Effect, s.log10p, s.significant
from a_peaks p join c_scored s on s.mapping_id = p.mapping_id and s.method = p.method
 and s.CHROM = p.CHROM and s.POS >= p.startPOS and s.POS <= p.endPOS"""
    out["c_false"] = """
select p.* from a_peaks p
where exists (select 1 from c_scored s where s.mapping_id = p.mapping_id and s.method = p.method)
  and not exists (select 1 from c_overlap o where o.mapping_id = p.mapping_id
                  and o.method = p.method and o.peak_id = p.peak_id)"""
    out["c_first"] = """
select * from (select *, row_number() over (partition by mapping_id, method, QTL order by peak_id) as rn
               from c_overlap) z where rn = 1"""
    out["c_union"] = """
select s.mapping_id, s.method, s.QTL, true as Simulated, o.peak_id is not null as Detected, s.CHROM, s.POS,
       s.RefAllele, s.Frequency, s.Effect, v.ve, s.log10p, s.significant, o.peak_BETA as BETA, o.startPOS,
       o.peakPOS, o.endPOS, o.peak_marker as detected_peak, o.max_log10p as interval_log10p,
       o.peak_AF1 as interval_Frequency, o.peak_id, o.interval_size, s.QTL = o.peak_marker as top_hit
from c_scored s
left join c_first o on o.mapping_id = s.mapping_id and o.method = s.method and o.QTL = s.QTL
left join v_exp v on v.trait_id = s.trait_id and v.QTL = s.QTL
union all
select mapping_id, method, peak_marker, false, true, CHROM, peakPOS, null, null, null, null, null, null,
       peak_BETA, startPOS, peakPOS, endPOS, peak_marker, max_log10p, peak_AF1, peak_id, interval_size, true
from c_false"""
    out["c_assess"] = f"""
select u.QTL, u.Simulated, u.Detected, u.CHROM, u.POS, u.RefAllele, {rnd('u.Frequency')} as Frequency,
       {rnd('u.Effect')} as Effect, {rnd('u.ve', 8)} as Simulated_QTL_VarExp, {rnd('u.log10p')} as log10p,
       u.significant, {rnd('u.BETA')} as BETA, u.startPOS, u.peakPOS, u.endPOS, u.detected_peak,
       {rnd('u.interval_log10p')} as interval_log10p, cast(null as double) as interval_var_exp,
       {rnd('u.interval_Frequency')} as interval_Frequency, u.peak_id, u.interval_size, u.top_hit,
       cast(m.nqtl as varchar) as nQTL, cast(m.rep as varchar) as simREP, cast(m.h2 as varchar) as h2,
       cast(m.maf as varchar) as maf, m.effect as effect_distribution, m.population as strain_set_id,
       m.algorithm as mode, case when m.pca then 'pca' else 'nopca' end as type, u.method as threshold,
       concat(m.algorithm, case when m.pca then '_PCA_' else '_noPCA_' end, u.method) as algorithm_id,
       cast({ALPHA} as double) as alpha, {CI_SIZE} as ci_size, {SNP_GROUPING} as snp_grouping
from c_union u join metadata m on m.mapping_id = u.mapping_id"""
    out["c_desig"] = """
select *, case when Simulated and Detected and (significant = 1 or significant is null) then 'Detected.CV'
               when Simulated and not Detected and (significant = 0 or significant is null) then 'Missed.CV'
               when Simulated and Detected and significant = 0 then 'CV.Not.Significant.In.Interval'
               when not Simulated and Detected then 'False.Discovery' end as designation
from c_assess"""
    out["c_counts"] = """
select nQTL, simREP, h2, maf, effect_distribution, strain_set_id, mode, type, threshold,
       count(*) filter (designation = 'Detected.CV') as Detected_CV,
       count(*) filter (designation = 'Missed.CV') as Missed_CV,
       count(*) filter (designation = 'CV.Not.Significant.In.Interval') as CV_Not_Significant_In_Interval,
       count(*) filter (designation = 'False.Discovery') as False_Discovery
from c_desig group by all"""
    return out
