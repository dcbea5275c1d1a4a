"""Domain tables derived from the driver's tables.

Every table is one SQL text that is valid in Spark and in DuckDB, so that the
operators (DataFrame code) and the oracles (SQL) start from the same rows. All
rows of the source tables take part; arithmetic on keys only spreads values.

The population is the return flag, a trait is a line number within it, the four
mapping arms are line status and discount class, markers are parts, strains
are supplier nations.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from locuspark.session import apply_settings, path_exists, scratch_dir
from locuspark.suite.oracle import oracle_tables

SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Analysis settings of the registered queries, sized for the small tables.
ALPHA = 0.05
CI_SIZE = 3
SNP_GROUPING = 5
CV_MAF = 0.05
CV_LD = 0.8


def _texts(dialect: str) -> dict[str, str]:
    spark = dialect == "spark"
    text = "string" if spark else "varchar"
    # Beyond 2,147,482 parts a position is no int any more, and the oracles fail.
    position = "bigint" if spark else "int"

    def sha(expr: str) -> str:
        return f"substring(sha2({expr}, 256), 1, 20)" if spark else f"substring(sha256({expr}), 1, 20)"

    def dec(expr: str) -> str:
        return f"format_string('%.10f', {expr})" if spark else f"printf('%.10f', {expr})"

    def flag(expr: str) -> str:
        return f"case when {expr} then 'TRUE' else 'FALSE' end"

    out: dict[str, str] = {}
    out["d_groups"] = f"""
select rf,
       case rf when 'A' then 'ce.panel' when 'N' then 'cb.panel' else 'ct.panel' end as population,
       case rf when 'A' then 'c_elegans' when 'N' then 'c_briggsae' else 'c_tropicalis' end as species,
       case rf when 'A' then '20220216' when 'N' then '20240129' else '20231201' end as vcf_release_id,
       cast(0.05 as double) as maf, cast(0.8 as double) as ms_ld, n_lines
from (select l_returnflag as rf, count(*) as n_lines from lineitem group by l_returnflag) g"""
    ms_string = (
        "concat('v=2|population=', lower(trim(population)), '|maf=', "
        + dec("maf")
        + ", '|species=', lower(trim(species)), '|vcf_release_id=', vcf_release_id, '|ms_ld=', "
        + dec("ms_ld")
        + ")"
    )
    out["d_sets"] = f"""
select rf, population, species, vcf_release_id, maf, ms_ld,
       {ms_string} as marker_set_hash_string, {sha(ms_string)} as marker_set_id
from d_groups"""
    out["d_part_of_set"] = """
select l_returnflag as rf, l_partkey as pk, count(*) as n_lines
from lineitem group by l_returnflag, l_partkey"""
    out["markers"] = f"""
select s.marker_set_id,
       concat(cast(p.p_partkey % 6 + 1 as {text}), ':', cast((p.p_partkey + 1) * 1000 as {text})) as marker,
       cast(p.p_partkey % 6 + 1 as {text}) as CHROM, cast((p.p_partkey + 1) * 1000 as {position}) as POS,
       case when p.p_size < 26 then 'A' else 'C' end as A1,
       case when p.p_type < 'M' then 'G' else 'T' end as A2
from d_part_of_set d join part p on p.p_partkey = d.pk join d_sets s on s.rf = d.rf"""
    out["marker_set_metadata"] = """
select s.marker_set_id, s.marker_set_hash_string, 'v=2' as hash_schema_version, s.population, s.maf,
       s.species, s.vcf_release_id, s.ms_ld, cast(n.n as int) as n_markers,
       case when s.rf = 'R' then cast(null as double) else n.n * cast(0.6 as double) end
         as n_independent_tests,
       case when s.rf = 'R' then null
            else concat(s.population, '_0.05_total_independent_tests.txt') end as eigen_source_file,
       'S0,S1,S2' as strain_list
from d_sets s join (select rf, count(*) as n from d_part_of_set group by rf) n on n.rf = s.rf"""
    trait_string = (
        "concat('v=2|parent=', marker_set_id, '|nqtl=', cast(nqtl as "
        + text
        + "), '|effect=', lower(trim(effect)), '|rep=', cast(rep as "
        + text
        + "), '|h2=', "
        + dec("h2")
        + ", '|cv_maf_effective=', "
        + dec("cv_maf_effective")
        + ", '|cv_ld=', "
        + dec("cv_ld")
        + ")"
    )
    out["d_trait_cells"] = """
select s.marker_set_id, s.rf, t.ln, s.population, s.species, s.vcf_release_id, s.ms_ld,
       case s.rf when 'A' then 5 when 'N' then 10 else 1 end as nqtl,
       case when t.ln <= 4 then t.ln else t.ln - 4 end as rep,
       case when t.ln <= 4 then cast(0.3 as double) else cast(0.8 as double) end as h2,
       s.maf, case when s.rf = 'R' then '0.2-0.3' else 'gamma' end as effect,
       cast(0.05 as double) as cv_maf_effective, cast(0.8 as double) as cv_ld
from (select l_returnflag as rf, l_linenumber as ln, count(*) as n from lineitem
      group by l_returnflag, l_linenumber) t join d_sets s on s.rf = t.rf"""
    out["traits"] = f"""
select {sha(trait_string)} as trait_id, {trait_string} as trait_hash_string, marker_set_id, nqtl,
       rep, h2, maf, effect, population, cv_maf_effective, cv_ld, '2024-01-01T00:00:00' as created_at,
       rf, ln
from d_trait_cells"""
    out["d_stats"] = """
select l_returnflag as rf, l_linenumber as ln,
       case when l_linestatus = 'O' then 'inbred' else 'loco' end as algorithm,
       l_discount >= cast(0.05 as double) as pca, l_partkey as pk, min(l_orderkey) as ok,
       max(l_quantity) as q, max(l_tax) as tax, max(l_extendedprice) as price
from lineitem
group by l_returnflag, l_linenumber, case when l_linestatus = 'O' then 'inbred' else 'loco' end,
         l_discount >= cast(0.05 as double), l_partkey"""
    map_string = f"concat('v=1|parent=', t.trait_id, '|algorithm=', a.algorithm, '|pca=', {flag('a.pca')})"
    out["metadata"] = f"""
select {sha(map_string)} as mapping_id, {map_string} as mapping_hash_string, t.trait_id,
       t.marker_set_id, 'v=1' as hash_schema_version, t.population, t.maf, t.nqtl, t.rep, t.h2,
       t.effect, a.algorithm, a.pca, cast(a.n as int) as n_markers,
       concat(cast(t.nqtl as {text}), '_', cast(t.rep as {text}), '_', cast(t.h2 as {text}), '_0.05_',
              t.effect, '_', t.population, '_lmm-exact_', a.algorithm, '_',
              case when a.pca then 'pca' else 'nopca' end,
              case when a.algorithm = 'loco' then '.mlma' else '.fastGWA' end) as source_file,
       '1.0' as processing_version, a.rf, a.ln
from (select rf, ln, algorithm, pca, count(*) as n from d_stats group by rf, ln, algorithm, pca) a
join traits t on t.rf = a.rf and t.ln = a.ln"""
    out["mappings"] = f"""
select m.population, m.mapping_id,
       concat(cast(pk % 6 + 1 as {text}), ':', cast((pk + 1) * 1000 as {text})) as marker,
       cast(0.05 as double) + cast(0.9 as double) * u as AF1, price / 100000 - cast(0.5 as double) as BETA,
       cast(0.1 as double) + tax as SE,
       case when q = 50 and tax = cast(0.08 as double) then cast(0 as double)
            when q = 50 and tax = cast(0.0 as double) then cast(null as double)
            when q = 1 then cast(1 as double) else u * u * u end as P
from (select rf, ln, algorithm, pca, pk, q, tax, price,
             cast(1 + (ok * 7919 + pk * 104729 + ln) % 1000003 as double) / 1000003 as u
      from d_stats) s
join metadata m on m.rf = s.rf and m.ln = s.ln and m.algorithm = s.algorithm and m.pca = s.pca"""
    out["d_geno"] = """
select l.l_returnflag as rf, l.l_partkey as pk, s.s_nationkey as nk,
       (cast(sum(l.l_quantity) as bigint) * 3 + l.l_partkey + s.s_nationkey * 7) % 11 as code
from lineitem l join supplier s on s.s_suppkey = l.l_suppkey
group by l.l_returnflag, l.l_partkey, s.s_nationkey"""
    allele = (
        "case when code < 5 then cast(-1 as double) when code < 10 then cast(1 as double) "
        "else cast(null as double) end"
    )
    out["genotypes"] = f"""
select s.marker_set_id, cast(g.pk % 6 + 1 as {text}) as CHROM, cast((g.pk + 1) * 1000 as {position}) as POS,
       concat('S', cast(g.nk as {text})) as strain, {allele} as allele
from d_geno g join d_sets s on s.rf = g.rf"""
    out["phenotypes"] = f"""
select t.trait_id, concat('S', cast(x.nk as {text})) as strain, x.q / x.n as phenotype
from (select l.l_returnflag as rf, l.l_linenumber as ln, s.s_nationkey as nk,
             sum(l.l_quantity) as q, count(*) as n
      from lineitem l join supplier s on s.s_suppkey = l.l_suppkey
      where s.s_nationkey <> 24
      group by l.l_returnflag, l.l_linenumber, s.s_nationkey) x
join traits t on t.rf = x.rf and t.ln = x.ln"""
    out["d_causal"] = """
select l_returnflag as rf, l_linenumber as ln, l_partkey as pk,
       case when l_partkey % 3 = 0 then 1 else 0 end as off_marker,
       max(l_tax) as tax, max(l_extendedprice) as price
from lineitem where l_quantity = 50 and l_discount >= cast(0.09 as double)
group by l_returnflag, l_linenumber, l_partkey"""
    out["causal_variants"] = f"""
select t.trait_id,
       concat(cast(c.pk % 6 + 1 as {text}), ':', cast((c.pk + 1) * 1000 + off_marker as {text})) as QTL,
       cast(c.pk % 6 + 1 as {text}) as CHROM, cast((c.pk + 1) * 1000 + off_marker as {position}) as POS,
       'A' as RefAllele, cast(0.05 as double) + 5 * tax as Frequency,
       price / 100000 - cast(0.3 as double) as Effect
from d_causal c join traits t on t.rf = c.rf and t.ln = c.ln"""
    out["causal_genotypes"] = f"""
select t.trait_id,
       concat(cast(c.pk % 6 + 1 as {text}), ':', cast((c.pk + 1) * 1000 + off_marker as {text})) as QTL,
       cast(c.pk % 6 + 1 as {text}) as CHROM, cast((c.pk + 1) * 1000 + off_marker as {position}) as POS,
       concat('S', cast(g.nk as {text})) as strain,
       case when off_marker = 1 then -({allele}) else {allele} end as allele
from d_causal c join d_geno g on g.rf = c.rf and g.pk = c.pk
join traits t on t.rf = c.rf and t.ln = c.ln"""
    # Calls of one variant file: every part in every supplier nation.
    out["d_calls"] = """
select l.l_partkey as pk, s.s_nationkey as nk,
       (cast(sum(l.l_quantity) as bigint) * 3 + l.l_partkey + s.s_nationkey * 7) % 13 as code
from lineitem l join supplier s on s.s_suppkey = l.l_suppkey group by l.l_partkey, s.s_nationkey"""
    out["d_variants"] = f"""
select p_partkey as pk, case p_partkey % 7 when 0 then 'I' when 1 then 'II' when 2 then 'III' when 3 then 'IV'
         when 4 then 'V' when 5 then 'X' else 'MtDNA' end as CHROM, cast((p_partkey + 1) * 1000 as {position}) as POS,
       case when p_size < 30 then '.' else concat('rs', cast(p_partkey as {text})) end as ID,
       case when p_size % 10 = 0 then 'AT' else 'A' end as REF,
       case when p_size % 9 = 0 then 'G,T' else 'G' end as ALT
from part"""
    # The strainfile of the verified run: one group has no marker set yet.
    out["d_strainfile"] = """
select population, maf, cast(null as double) as ms_ld, concat('/vcf/', vcf_release_id, '.vcf.gz') as vcf
from d_sets
union all
select 'xx.panel', maf, cast(0.7 as double), '/vcf/20200101.vcf.gz' from d_sets where rf = 'A'"""
    # One parameter set and one file name per line item.
    out["id_rows"] = f"""
select l_orderkey, l_linenumber as nqtl, concat(' P', cast(l_suppkey as {text}), ' ') as population,
       cast(0.01 as double) + l_tax as maf,
       case l_returnflag when 'A' then ' C_elegans' when 'N' then 'c_briggsae ' else 'c_tropicalis' end as species,
       case l_returnflag when 'A' then '20220216' when 'N' then '20240129' else '20231201' end as vcf_release_id,
       cast(0.5 as double) + l_discount as ms_ld, case when l_tax < cast(0.04 as double) then ' Gamma'
       else '0.2-0.3' end as effect, cast(l_quantity as int) as rep, cast(0.1 as double) + l_discount as h2,
       cast(0.01 as double) + l_tax as cv_maf_effective, cast(0.9 as double) as cv_ld,
       case when l_linestatus = 'O' then 'Inbred' else 'loco ' end as algorithm,
       l_discount >= cast(0.05 as double) as pca, l_partkey
from lineitem"""
    out["name_rows"] = f"""
select l_orderkey, l_linenumber, l_partkey,
       concat('/data/', cast(l_orderkey as {text}), '/', cast(l_linenumber as {text}), '_', cast(l_suppkey as {text}),
              '_', cast(l_discount as {text}), '_', cast(l_tax as {text}), '_',
              case l_returnflag when 'A' then 'gamma' when 'N' then 'uniform' else '0.2-0.3' end,
              '_pop_', cast(l_partkey as {text}), '_processed_LMM-EXACT-',
              case when l_linestatus = 'O' then 'INBRED' else 'LOCO' end,
              case when l_quantity > 25 then '_PCA' else '' end,
              case when l_tax > cast(0.05 as double) then '_mapping.tsv' when l_tax > cast(0.02 as double)
                   then '_mapping_reprocessed.tsv' when l_tax > cast(0.01 as double) then '_qtl_regions_reprocessed.tsv'
                   else '.txt' end) as mapping_path,
       concat('runs/', cast(l_linenumber as {text}), '_', cast(l_suppkey as {text}), '_', cast(l_discount as {text}), '_',
              cast(l_tax as {text}), '_', case l_returnflag when 'A' then 'gamma' else '0.2-0.3' end, '_pop.',
              cast(l_partkey as {text}), '_lmm-exact_', case when l_linestatus = 'O' then 'inbred.fastGWA'
              else 'loco_pca.mlma' end) as result_path,
       concat('pop_', cast(l_suppkey as {text}), case when l_linestatus = 'O' then '_0.05' else '_x' end,
              '_total_independent_tests.txt') as eigen_file,
       case when l_returnflag = 'A' then concat('/vcf/W', cast(20200000 + l_partkey as {text}), '.', cast(l_suppkey as {text}), '.vcf.gz')
            else cast(20210000 + l_partkey as {text}) end as vcf,
       case l_returnflag when 'A' then 'gamma' when 'N' then concat('0.', cast(l_linenumber as {text}), '-0.9')
            else 'normal' end as effect_spec,
       case l_linenumber when 1 then '0|0' when 2 then '0/0' when 3 then '1|1' when 4 then '1/1' when 5 then '0|1'
            when 6 then '.|.' else '1|2' end as gt,
       case when l_linestatus = 'O' then 'inbred' else 'loco' end as algorithm,
       l_discount >= cast(0.05 as double) as pca,
       case when l_quantity > 25 then 'LMM-exact-inbred_pca_EIGEN' else 'loco_nopca_BF' end as algorithm_id
from lineitem"""
    # Association rows before ingest: one per line item, so markers repeat within a mapping,
    # and a few suppliers deliver malformed fields for the quality checks to find.
    out["raw_rows"] = f"""
select m.population, m.mapping_id,
       concat(cast(l_partkey % 6 + 1 as {text}), ':', cast((l_partkey + 1) * 1000 as {text})) as marker,
       cast(l_partkey % 6 + 1 as {text}) as CHROM, cast((l_partkey + 1) * 1000 as {position}) as POS,
       l_orderkey as ordinal, l_suppkey, l_quantity, l_extendedprice / 100000 as BETA,
       case when l_suppkey = 7 then cast(null as double) else l_quantity / 51 end as P,
       case when l_suppkey < 3 then upper(m.mapping_id) else m.mapping_id end as tagged_id,
       case when l_suppkey < 3 then 'other' else m.algorithm end as tagged_algorithm,
       case when l_suppkey = 5 then cast(null as boolean) else m.pca end as tagged_pca,
       case when l_suppkey < 3 then 'chr1_100' else concat(cast(l_partkey % 6 + 1 as {text}), ':',
            cast((l_partkey + 1) * 1000 as {text})) end as tagged_qtl
from lineitem l join metadata m on m.rf = l.l_returnflag and m.ln = l.l_linenumber
 and m.algorithm = case when l.l_linestatus = 'O' then 'inbred' else 'loco' end
 and m.pca = (l.l_discount >= cast(0.05 as double))"""
    # Strainfile: one group per customer, with values on both sides of the allowed ranges.
    out["strain_rows"] = f"""
select concat(' g', cast(c_custkey as {text}), ' ') as grp,
       case when c_nationkey < 9 then 'C_elegans' when c_nationkey < 17 then 'c_briggsae '
            when c_nationkey < 23 then 'c_tropicalis' else 'd_other' end as species,
       concat('/vcf/', cast(20200000 + c_custkey as {text}), '.vcf.gz') as vcf,
       c_acctbal / 10000 as ms_maf, cast(c_nationkey as double) / 24 as ms_ld,
       concat('S', cast(c_nationkey as {text}), ',S', cast(c_nationkey + 1 as {text})) as strains
from customer"""
    # Work-directory logs: a task per order, its files are the order's lines.
    out["work_tasks"] = f"""
select concat('w', cast(o_orderkey as {text})) as work_dir,
       case o_orderpriority when '1-URGENT' then 'nf-GCTA_PERFORM_GWA' when '2-HIGH' then 'GCTA_MAKE_GRM'
            when '3-MEDIUM' then ' PLINK_RECODE_MS_VCF ' when '5-LOW' then 'DB_MIGRATION_ASSESS_SIMS'
            else null end as process,
       case when o_orderstatus = 'O' then concat('ce.n', cast(100 + c_nationkey as {text}), '_r1')
            else 'ce.full' end as tag
from orders join customer on c_custkey = o_custkey"""
    out["work_usage"] = f"""
select concat('w', cast(o_orderkey as {text})) as work_dir, o_totalprice * 1048576 as total_bytes
from orders where o_orderstatus <> 'P'"""
    out["work_files"] = f"""
select concat('w', cast(l_orderkey as {text})) as work_dir,
       case when l_returnflag = 'R' then 'l' else 'f' end as kind, l_extendedprice as bytes,
       concat('part', cast(l_partkey as {text}), '.n', cast(l_suppkey % 7 + 90 as {text}), '_',
              cast(l_linenumber as {text}),
              case when l_tax < cast(0.03 as double) then '.parquet' when l_tax < cast(0.06 as double)
                   then '.tsv' else '' end) as file_name
from lineitem"""
    # Outcome log: every event is an attempt at one cell; 'error' and 'view' fail.
    out["outcomes"] = f"""
select event_id as attempt, case when event_id % 5 = 0 then 'old_run' else 'this_run' end as session,
       concat('h', cast(event_id as {text})) as task_hash,
       case user_id % 3 when 0 then 'c_elegans' when 1 then 'c_briggsae' else 'c_tropicalis' end as species,
       case user_id % 3 when 0 then 'ce.panel' when 1 then 'cb.panel' else 'ct.panel' end as grp,
       cast(0.05 as double) as maf,
       case user_id % 3 when 0 then '5' when 1 then '10' else '1' end as nqtl,
       case user_id % 3 when 2 then '0.2-0.3' else 'gamma' end as effect,
       case when user_id % 2 = 0 then cast(0.3 as double) else cast(0.8 as double) end as h2,
       cast(user_id % 7 + 1 as int) as rep,
       case when value < 20 then 'inbred' else 'loco' end as mode,
       case when value < 50 then 'pca' else 'nopca' end as type,
       case event_type when 'error' then 137 when 'view' then 1 else 0 end as exit_code
from events"""
    if not spark:
        out.update(oracle_tables())
    return out


def _names(texts: dict[str, str], text: str) -> set[str]:
    return {name for name in texts if re.search(rf"\b{name}\b", text)}


def with_tables(body: str, dialect: str = "duckdb", stored: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the domain tables it refers to, in dependency order.

    In oracles every table is computed once, however often it is referred to.
    ``stored`` has texts that read a table instead of computing it.
    """
    texts = _texts(dialect) | (stored or {})
    needed: set[str] = set()
    pending = _names(texts, body)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending |= _names(texts, texts[name]) - {name}
    once = "materialized " if dialect == "duckdb" else ""
    parts = [f"{name} as {once}({texts[name]})" for name in texts if name in needed]
    if not parts:
        return body
    body = body.strip()
    if body.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(parts) + ",\n" + body[15:]
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body


_INTERNAL = ("rf", "ln")
_HIVE = {"mappings": ["population", "mapping_id"]}
# Tables that others are made from. Read back they are computed once, and a join
# with a few rows is planned as one: the large side is not shuffled to learn that.
_SHARED = ("d_sets", "d_geno", "traits", "metadata")
_cache: dict[tuple[str, str, str], str] = {}
_frames: dict[tuple[int, str], DataFrame] = {}


class Domain:
    """Domain tables of one data folder, written once per session to the shared folder.

    Later queries scan those files, so column pruning, pushed filters and
    partition pruning work as they would on a stored database.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, body: str, stored: dict[str, str] | None = None) -> DataFrame:
        """Run a SQL text over the domain tables, computed from the source files."""
        text = with_tables(body, "spark", stored)
        for name in SOURCES:
            text = re.sub(
                rf"\b(from|join)\s+{name}\b", rf"\1 parquet.`{self.sf_dir}/{name}.parquet`", text,
            )
        return self.spark.sql(text)

    def kept(self, name: str, build) -> str:
        """Path of something written once per session; ``build(path)`` writes it.

        Written again where the shared folder has been cleared meanwhile.
        """
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _cache or not path_exists(self.spark, _cache[key]):
            target = scratch_dir(self.spark, name)
            build(target)
            _cache[key] = target
        return _cache[key]

    def _stored(self, name: str) -> dict[str, str]:
        """The shared tables that ``name`` is made from, as texts that read them."""
        found: dict[str, str] = {}
        texts = _texts("spark")
        pending = _names(texts, texts[name]) - {name}
        seen = {name}
        while pending:
            one = pending.pop()
            seen.add(one)
            if one in _SHARED:
                found[one] = f"select * from parquet.`{self.path(one)}`"
            else:
                pending |= _names(texts, texts[one]) - seen
        return found

    def path(self, name: str) -> str:
        def build(target: str) -> None:
            df = self.sql(f"select * from {name}", self._stored(name))
            if name in _HIVE:
                keys = _HIVE[name]
                # AQE splits a hot partition and merges small ones before the write.
                df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(target)
            else:
                df.write.parquet(target)

        return self.kept(f"domain-{name}", build)

    def table(self, name: str) -> DataFrame:
        path = self.path(name)
        key = (id(self.spark), path)
        if key not in _frames:
            df = self.spark.read.parquet(path)
            _frames[key] = df.drop(*[c for c in _INTERNAL if c in df.columns])
        return _frames[key]

    def staged(self, name: str, build) -> DataFrame:
        """A result several queries start from."""
        path = self.kept(f"staged-{name}", lambda target: build().write.parquet(target))
        return self.spark.read.parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)
