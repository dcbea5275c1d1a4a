"""Filters, joins and summaries over the stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuspark.operators import queries as Q
from locuspark.operators import sets
from locuspark.plans import assess as plan
from locuspark.suite.assessment import rounded
from locuspark.suite.domain import ALPHA
from locuspark.suite.oracle import rnd
from locuspark.suite.registry import query

_STATS = f"{rnd('AF1')} as AF1, {rnd('BETA')} as BETA, {rnd('SE')} as SE, {rnd('P', 12)} as P"
_META = """mapping_id, mapping_hash_string, trait_id, marker_set_id, hash_schema_version, population, maf,
           nqtl, rep, h2, effect, algorithm, pca, n_markers, source_file, processing_version"""


@query(
    "fil01_by_population",
    f"select population, mapping_id, marker, {_STATS} from mappings where population = 'ce.panel'",
)
def _(d):
    return rounded(Q.by_population(d.mappings, "ce.panel"), P=12)


def _one_id(d) -> str:
    return d.metadata.agg(F.min("mapping_id")).first()[0]


@query(
    "fil02_by_mapping_id",
    f"""select population, mapping_id, marker, {_STATS} from mappings
        where mapping_id = (select min(mapping_id) from metadata)""",
)
def _(d):
    return rounded(Q.by_mapping_id(d.mappings, _one_id(d)), P=12)


@query(
    "fil03_by_method",
    f"""select {_META} from metadata where population = 'cb.panel' and algorithm = 'loco' and pca""",
)
def _(d):
    return Q.by_method(d.metadata, "cb.panel", "loco", True)


@query("fil04_by_architecture", f"select {_META} from metadata where h2 = 0.3 and nqtl = 10")
def _(d):
    return Q.by_architecture(d.metadata, h2=0.3, nqtl=10)


@query(
    "fil05_all_metadata",
    f"select {_META}, count(*) over (partition by population) as n_in_population from metadata",
)
def _(d):
    return Q.all_metadata(d.metadata)


_FULL = f"""select s.mapping_id, s.population, k.CHROM, k.POS, s.marker, k.A1, k.A2, {rnd('s.P', 12)} as P,
       {rnd('s.BETA')} as BETA, m.marker_set_id, m.maf, m.nqtl, m.rep, m.h2, m.effect, m.algorithm, m.pca
  from mappings s left join metadata m on m.mapping_id = s.mapping_id
  left join markers k on k.marker_set_id = m.marker_set_id and k.marker = s.marker"""


@query("joi01_mapping_data", _FULL)
def _(d):
    out = Q.mapping_data(d.mappings, d.metadata, d.markers)
    return rounded(out.drop("AF1", "SE"), P=12)


@query(
    "joi01_mapping_data_filtered",
    _FULL + " where s.population = 'ct.panel' and m.h2 = 0.8 and m.algorithm = 'inbred'",
)
def _(d):
    out = Q.mapping_data(
        d.mappings, d.metadata, d.markers, population="ct.panel", h2=0.8, algorithm="inbred"
    )
    return rounded(out.drop("AF1", "SE"), P=12)


_THRESH = f"""select s.mapping_id, s.population, m.maf, s.marker, k.CHROM, k.POS, {rnd('s.AF1')} as AF1,
       {rnd('s.BETA')} as BETA, {rnd('s.SE')} as SE, {rnd('s.P', 12)} as P, cast(null as double) as var_exp
  from mappings s left join metadata m on m.mapping_id = s.mapping_id
  left join markers k on k.marker_set_id = m.marker_set_id and k.marker = s.marker"""


@query(
    "joi02_threshold_data",
    _THRESH + " where s.mapping_id = (select min(mapping_id) from metadata)",
)
def _(d):
    return rounded(Q.threshold_data(d.mappings, d.metadata, d.markers, _one_id(d)), P=12)


@query(
    "joi03_threshold_data_bulk",
    _THRESH + " where s.mapping_id in (select mapping_id from metadata where rep >= 2)",
)
def _(d):
    ids = d.metadata.where(F.col("rep") >= 2)
    return rounded(Q.threshold_data_bulk(d.mappings, d.metadata, d.markers, ids), P=12)


@query(
    "src15_mapping_direct",
    f"""select s.mapping_id, s.population, m.maf, s.marker, split_part(s.marker, ':', 1) as CHROM,
               cast(split_part(s.marker, ':', 2) as int) as POS, {rnd('s.AF1')} as AF1, {rnd('s.BETA')} as BETA,
               {rnd('s.SE')} as SE, {rnd('s.P', 12)} as P, cast(null as double) as var_exp
        from mappings s join metadata m on m.mapping_id = s.mapping_id
        where s.mapping_id = (select min(mapping_id) from metadata)""",
)
def _(d):
    out = Q.mapping_direct(d.mappings, d.metadata, _one_id(d))
    return rounded(sets.canonical_order(out), P=12)


@query(
    "agg01_simulation_summary",
    """select population, maf, nqtl, h2, algorithm, pca, count(distinct rep) as n_reps,
              count(distinct mapping_id) as n_mappings
       from metadata group by population, maf, nqtl, h2, algorithm, pca""",
)
def _(d):
    return Q.simulation_summary(d.metadata)


@query(
    "agg02_architecture_summary",
    """select population, maf, h2, nqtl, count(distinct algorithm) as n_algorithms, count(distinct rep) as n_reps,
              count(*) as n_mappings, string_agg(distinct algorithm, ', ' order by algorithm) as algorithms
       from metadata group by population, maf, h2, nqtl""",
)
def _(d):
    return Q.architecture_summary(d.metadata)


@query(
    "agg03_marker_count",
    "select mapping_id, count(distinct marker) as n_markers from mappings group by mapping_id",
)
def _(d):
    return Q.marker_count(d.mappings)


@query(
    "agg34_chrom_extent",
    """select marker_set_id, CHROM, count(*) as n_markers, min(POS) as min_pos, max(POS) as max_pos
       from markers group by marker_set_id, CHROM""",
)
def _(d):
    return Q.chrom_extent(d.markers)


@query(
    "pip08_analysis_bundle",
    f"""select t.*, x.n_markers, {rnd(f'-log10({ALPHA} / x.n_markers)')} as bf_threshold,
               case when x.n_independent_tests > 0 then {rnd(f'-log10({ALPHA} / x.n_independent_tests)')} end
                 as eigen_threshold
        from ({_THRESH}) t join metadata m on m.mapping_id = t.mapping_id
        join marker_set_metadata x on x.marker_set_id = m.marker_set_id""",
)
def _(d):
    joined = Q.mapping_data(d.mappings, d.metadata, d.markers)
    return rounded(
        plan.analysis_bundle(joined, d.metadata, d.marker_set_metadata, ALPHA), P=12
    )


@query(
    "srt01_canonical_order",
    "select mapping_id, CHROM, POS, marker from raw_rows",
)
def _(d):
    return sets.canonical_order(d.raw_rows.select("mapping_id", "CHROM", "POS", "marker"))


@query("srt05_marker_order", "select marker_set_id, CHROM, POS, marker from markers")
def _(d):
    return sets.marker_order(d.markers.select("marker_set_id", "CHROM", "POS", "marker"))


@query(
    "win05_dedup_first",
    """select mapping_id, marker, ordinal, l_suppkey from (
         select *, row_number() over (partition by mapping_id, marker
                    order by ordinal, l_suppkey, l_quantity) as rn from raw_rows) z where rn = 1""",
)
def _(d):
    rows = d.raw_rows.select("mapping_id", "marker", "ordinal", "l_suppkey", "l_quantity")
    order = ["ordinal", "l_suppkey", "l_quantity"]
    return sets.dedup_first(rows, ["mapping_id", "marker"], order).drop("l_quantity")


@query(
    "set01_union_by_name",
    """select mapping_id, marker, POS, cast(null as bigint) as ordinal from raw_rows where CHROM = '1'
       union all select mapping_id, marker, null, ordinal from raw_rows where CHROM <> '1'""",
)
def _(d):
    rows = d.raw_rows
    first = rows.where(F.col("CHROM") == "1").select("mapping_id", "marker", "POS")
    second = rows.where(F.col("CHROM") != "1").select("ordinal", "marker", "mapping_id")
    return sets.union_all([first, second])


_OLD = "select mapping_id, marker, BETA from raw_rows where population <> 'ct.panel'"
_NEW = "select mapping_id, marker, BETA + 1 as BETA from raw_rows where population <> 'ce.panel'"


def _old_new(d):
    rows = d.raw_rows
    old = rows.where(F.col("population") != "ct.panel").select("mapping_id", "marker", "BETA")
    new = rows.where(F.col("population") != "ce.panel").select(
        "mapping_id", "marker", (F.col("BETA") + 1).alias("BETA")
    )
    return old, new


@query(
    "set02_upsert",
    f"""select mapping_id, marker, {rnd('BETA')} as BETA from (
          select * from ({_OLD}) o where mapping_id not in (select mapping_id from ({_NEW}) n)
          union all {_NEW}) z""",
)
def _(d):
    return rounded(sets.upsert(*_old_new(d), ["mapping_id"]))


@query(
    "set03_insert_absent",
    f"""select mapping_id, marker, {rnd('BETA')} as BETA from (
          select * from ({_NEW}) n where mapping_id not in (select mapping_id from ({_OLD}) o)
          union all {_OLD}) z""",
)
def _(d):
    return rounded(sets.insert_absent(*_old_new(d), ["mapping_id"]))


@query(
    "set05_common_strains",
    "select strain from genotypes intersect select strain from phenotypes",
)
def _(d):
    return sets.common_strains(d.genotypes, d.phenotypes)


@query(
    "set06_missing_columns",
    "select count(*) as rows_checked, 'CHROM' as missing_columns from mappings",
)
def _(d):
    absent = sets.missing_columns(d.mappings, ["mapping_id", "marker", "CHROM", "P"])
    return d.mappings.agg(
        F.count(F.lit(1)).alias("rows_checked"), F.lit(",".join(absent)).alias("missing_columns")
    )
