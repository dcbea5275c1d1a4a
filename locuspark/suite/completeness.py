"""Expected grids, verification, replay slots and outcome logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.operators import grid as G
from locuspark.operators import sets
from locuspark.plans import verify as V
from locuspark.suite.assessment import rounded
from locuspark.suite.domain import CV_LD, CV_MAF, Domain
from locuspark.suite.oracle import rnd
from locuspark.suite.registry import query

NQTL, H2, EFFECT, REPS = (1, 5, 10), (0.3, 0.8), ("gamma", "0.2-0.3"), 4

_GRID = """(values (1), (5), (10)) a(nqtl), (values (cast(0.3 as double)), (cast(0.8 as double))) b(h2),
           (values ('gamma'), ('0.2-0.3')) c(effect)"""
_ARMS = "(values ('inbred'), ('loco')) e(algorithm), (values (true), (false)) f(pca)"
_REPS = "(values (1), (2), (3), (4)) r(rep)"
_HYDRATED = """select s.population, s.maf, coalesce(s.ms_ld, m.ms_ld) as ms_ld, s.vcf, m.species,
       m.vcf_release_id, m.marker_set_id, m.n_markers, m.n_independent_tests,
       m.marker_set_id is not null as marker_set_metadata_present
  from d_strainfile s left join marker_set_metadata m on m.population = s.population and m.maf = s.maf"""


def groups(d: Domain) -> DataFrame:
    return G.hydrate_groups(d.table("d_strainfile"), d.marker_set_metadata)


def expectation(d: Domain) -> V.Expectation:
    return V.Expectation(groups(d), NQTL, H2, EFFECT, REPS, CV_MAF, CV_LD)


def components(d: Domain) -> dict[str, tuple[DataFrame, str]]:
    return {
        "marker_sets_markers": (d.markers, "marker_set_id"),
        "marker_sets_genotypes": (d.genotypes, "marker_set_id"),
        "marker_set_metadata": (d.marker_set_metadata, "marker_set_id"),
        "traits_metadata_files": (d.traits, "trait_id"),
        "causal_variants_files": (d.causal_variants, "trait_id"),
        "phenotypes_files": (d.phenotypes, "trait_id"),
        "causal_genotypes_files": (d.causal_genotypes, "trait_id"),
        "mapping_data_files": (d.mappings, "mapping_id"),
        "mapping_meta_files": (d.metadata, "mapping_id"),
        "mappings_metadata_rows": (d.metadata, "mapping_id"),
    }


@query("joi16_hydrate_groups", _HYDRATED)
def _(d):
    return groups(d)


@query(
    "joi12_parameter_grid",
    f"""select g.population, nqtl, effect, h2, cast(rep as int) as rep, algorithm, pca
        from (select distinct population from metadata) g, {_GRID}, {_REPS}, {_ARMS}""",
)
def _(d):
    return G.parameter_grid(
        d.metadata.select("population").distinct(),
        NQTL,
        EFFECT,
        H2,
        REPS,
        ("inbred", "loco"),
        (True, False),
    )


@query(
    "joi13_fan_out",
    """select trait_id, mode, type, threshold from traits, (values ('inbred'), ('loco')) a(mode),
         (values ('pca'), ('nopca')) b(type), (values ('BF'), ('EIGEN')) c(threshold)""",
)
def _(d):
    return G.fan_out(d.traits.select("trait_id"))


_CELL = "population, nqtl, h2, effect, algorithm, pca"
_OBS = f"""select {_CELL}, count(*) as n_mappings, count(distinct trait_id) as n_distinct_traits,
       count(distinct rep) as n_distinct_rep from metadata group by {_CELL}"""


@query("agg17_observed_cells", _OBS)
def _(d):
    return G.observed_cells(d.metadata)


_OBS_TRAITS = f"""select population, nqtl, h2, effect, max(n_distinct_traits) as n_traits,
       max(n_distinct_rep) as n_distinct_rep from ({_OBS}) o group by population, nqtl, h2, effect"""


@query("agg18_observed_traits", _OBS_TRAITS)
def _(d):
    return G.observed_traits(G.observed_cells(d.metadata))


@query(
    "agg19_observed_grid",
    f"""select string_agg(distinct population, ',' order by population) as population, '1,5,10' as nqtl,
               '0.3,0.8' as h2, string_agg(distinct effect, ',' order by effect) as effect,
               string_agg(distinct algorithm, ',' order by algorithm) as algorithm, 'false,true' as pca,
               max(n_distinct_rep) as reps_max from ({_OBS}) o""",
)
def _(d):
    return G.observed_grid(G.observed_cells(d.metadata))


_DELTA = f"""select coalesce(e.population, o.population) as population, coalesce(e.nqtl, o.nqtl) as nqtl,
       coalesce(e.h2, o.h2) as h2, coalesce(e.effect, o.effect) as effect,
       coalesce(e.algorithm, o.algorithm) as algorithm, coalesce(e.pca, o.pca) as pca,
       cast(coalesce(x, 0) as bigint) as expected, coalesce(n_mappings, 0) as observed,
       cast(greatest(coalesce(x, 0) - coalesce(n_mappings, 0), 0) as bigint) as missing,
       case when x > 0 then {rnd('coalesce(n_mappings, 0) / x')} end as pct_complete
  from (select s.population, nqtl, h2, effect, algorithm, pca, {REPS} as x
        from (select population from d_strainfile) s, {_GRID}, {_ARMS}) e
  full join ({_OBS}) o on o.population = e.population and o.nqtl = e.nqtl and o.h2 = e.h2
   and o.effect = e.effect and o.algorithm = e.algorithm and o.pca = e.pca"""


def delta(d: Domain) -> DataFrame:
    return G.cell_delta(
        V.expected_cells(expectation(d)),
        G.observed_cells(d.metadata),
        V.MAPPING_CELL,
        observed_col="n_mappings",
    )


@query("joi14_cell_delta", _DELTA)
def _(d):
    return rounded(delta(d))


@query(
    "srt03_top_gaps",
    f"""select * from ({_DELTA}) z where missing > 0
        order by missing desc, population, nqtl, h2, effect, algorithm, pca limit 10""",
)
def _(d):
    return rounded(G.top_gaps(delta(d), 10))


def _sha(text: str) -> str:
    return f"substring(sha256({text}), 1, 20)"


_EXPECTED_IDS = f"""select *, {_sha("concat('v=1|parent=', trait_id, '|algorithm=', algorithm, '|pca=', case when pca then 'TRUE' else 'FALSE' end)")} as mapping_id
from (select g.population, nqtl, h2, effect, cast(rep as int) as rep, algorithm, pca,
        {_sha("concat('v=2|parent=', g.marker_set_id, '|nqtl=', nqtl, '|effect=', effect, '|rep=', rep, '|h2=', printf('%.10f', h2), '|cv_maf_effective=', printf('%.10f', cast(0.05 as double)), '|cv_ld=', printf('%.10f', cast(0.8 as double)))")} as trait_id
      from (select * from ({_HYDRATED}) h where marker_set_metadata_present) g, {_GRID}, {_REPS}, {_ARMS}) t"""


@query(
    "joi15_missing_ids",
    f"""select population, nqtl, h2, effect, rep, algorithm, pca, mapping_id from ({_EXPECTED_IDS}) x
        where mapping_id not in (select mapping_id from metadata)""",
)
def _(d):
    ids = V.expected_ids(expectation(d))
    return G.missing_ids(ids, d.metadata, "mapping_id").select(
        "population", "nqtl", "h2", "effect", "rep", "algorithm", "pca", "mapping_id"
    )


_N = "count(distinct"
_COUNTS = " union all ".join(
    f"select '{c}' as component, {_N} {k}) as observed, {x} as expected from {t}"
    for c, k, t, x in [
        ("marker_sets_markers", "marker_set_id", "markers", 4),
        ("marker_sets_genotypes", "marker_set_id", "genotypes", 4),
        ("marker_set_metadata", "marker_set_id", "marker_set_metadata", 4),
        ("traits_metadata_files", "trait_id", "traits", 192),
        ("causal_variants_files", "trait_id", "causal_variants", 192),
        ("phenotypes_files", "trait_id", "phenotypes", 192),
        ("causal_genotypes_files", "trait_id", "causal_genotypes", 192),
        ("mapping_data_files", "mapping_id", "mappings", 768),
        ("mapping_meta_files", "mapping_id", "metadata", 768),
        ("mappings_metadata_rows", "mapping_id", "metadata", 768),
    ]
)
_SUMMARY = f"""select component, cast(expected as bigint) as expected, observed,
       cast(greatest(expected - observed, 0) as bigint) as missing,
       {rnd('least(observed / expected, 1.0)')} as pct_complete from ({_COUNTS}) z"""


@query("agg21_component_summary", _SUMMARY)
def _(d):
    counts = V.component_counts(components(d))
    return rounded(
        V.component_summary(counts, {"marker_set": 4, "trait": 192, "mapping": 768})
    )


@query(
    "agg22_marker_set_coverage",
    f"""select population, maf, marker_set_id, marker_set_id is not null as metadata_row_exists,
               coalesce(marker_set_id in (select marker_set_id from markers), false) as markers_exist,
               coalesce(marker_set_id in (select marker_set_id from genotypes), false) as genotypes_exist,
               n_markers, {rnd('n_independent_tests', 6)} as n_independent_tests from ({_HYDRATED}) h""",
)
def _(d):
    return rounded(V.marker_set_coverage(groups(d), d.markers, d.genotypes), 6)


@query(
    "pip07_verify",
    f"""select component, expected, observed, missing, pct_complete, status from ({_SUMMARY}) s,
         (select case when max(missing) > 0 then 'incomplete' else 'complete' end as status from ({_SUMMARY}) q) t""",
)
def _(d):
    out = V.verify(d.metadata, components(d), d.markers, d.genotypes, expectation(d))
    status = out["status"].first()["status"]
    return rounded(out["summary"].withColumn("status", F.lit(status)))


@query(
    "pip07_verify_traits_delta",
    f"""select coalesce(e.population, o.population) as population, coalesce(e.nqtl, o.nqtl) as nqtl,
               coalesce(e.h2, o.h2) as h2, coalesce(e.effect, o.effect) as effect,
               cast(coalesce(x, 0) as bigint) as expected, coalesce(n_traits, 0) as observed,
               cast(greatest(coalesce(x, 0) - coalesce(n_traits, 0), 0) as bigint) as missing,
               case when x > 0 then {rnd('coalesce(n_traits, 0) / x')} end as pct_complete
        from (select s.population, nqtl, h2, effect, {REPS} as x from (select population from d_strainfile) s, {_GRID}) e
        full join ({_OBS_TRAITS}) o on o.population = e.population and o.nqtl = e.nqtl and o.h2 = e.h2
         and o.effect = e.effect""",
)
def _(d):
    out = V.verify(d.metadata, components(d), d.markers, d.genotypes, expectation(d))
    return rounded(out["traits_delta"])


@query(
    "agg16_short_cells",
    """select population, maf, nqtl, effect, h2, algorithm, pca, count(distinct rep) as n_reps, 4 as expected_reps
       from metadata group by population, maf, nqtl, effect, h2, algorithm, pca having count(distinct rep) <> 4""",
)
def _(d):
    return G.short_cells(d.metadata, 4)


@query(
    "agg25_empty_mappings",
    f"""select mapping_id from ({_EXPECTED_IDS}) x
        where mapping_id not in (select mapping_id from mappings)""",
)
def _(d):
    from locuspark.sources.catalog import empty_mappings

    return empty_mappings(V.expected_ids(expectation(d)).select("mapping_id"), d.mappings)


_KEY = "species, grp, nqtl, effect, h2, rep"
_LATEST = f"""select * from (select *, row_number() over (partition by {_KEY}, mode, type order by attempt desc) as rn
                from outcomes) z where rn = 1 and exit_code <> 0"""


def latest_failures(d: Domain) -> DataFrame:
    key = ["species", "grp", "nqtl", "effect", "h2", "rep", "mode", "type"]
    return sets.latest_state(d.outcomes, key, "attempt")


@query(
    "win09_latest_state",
    f"select {_KEY}, mode, type, attempt, task_hash, exit_code from ({_LATEST}) y",
)
def _(d):
    return latest_failures(d).select(
        "species", "grp", "nqtl", "effect", "h2", "rep", "mode", "type", "attempt", "task_hash", "exit_code"
    )


@query(
    "agg29_failures_by_exit",
    f"select exit_code, count(*) as n from ({_LATEST}) y group by exit_code",
)
def _(d):
    return G.failures_by_exit(latest_failures(d))


def manifest(d: Domain) -> DataFrame:
    return latest_failures(d).withColumnRenamed("grp", "group")


@query(
    "fil10_replay_filter",
    f"""select species, population, nqtl, effect, h2, rep, trait_id from (
          select m.species, t.* from traits t join marker_set_metadata m on m.marker_set_id = t.marker_set_id) g
        where exists (select 1 from ({_LATEST}) f where f.species = g.species and f.grp = g.population
                      and f.nqtl = cast(g.nqtl as varchar) and f.effect = g.effect
                      and cast(f.h2 as float) = cast(g.h2 as float) and f.rep = g.rep)""",
)
def _(d):
    runs = (
        d.traits.join(d.marker_set_metadata.select("marker_set_id", "species"), "marker_set_id")
        .withColumn("group", F.col("population"))
    )
    return G.replay_filter(runs, manifest(d)).select(
        "species", "population", "nqtl", "effect", "h2", "rep", "trait_id"
    )


@query(
    "set07_delete_slots",
    f"""select t.mapping_id, t.trait_id from metadata t where not exists (
          select 1 from ({_LATEST}) f where f.grp = t.population and f.nqtl = cast(t.nqtl as varchar)
           and f.effect = t.effect and f.h2 = t.h2 and f.rep = t.rep)""",
)
def _(d):
    ids = G.slot_ids(manifest(d), d.marker_set_metadata, CV_MAF, CV_LD)
    return G.delete_slots(d.metadata.select("mapping_id", "trait_id"), ids, "mapping_id")


@query(
    "set07_delete_slots_of_mappings",
    f"""select s.population, count(*) as n_rows, count(distinct s.mapping_id) as n_mappings
        from mappings s join metadata t on t.mapping_id = s.mapping_id where not exists (
          select 1 from ({_LATEST}) f where f.grp = t.population and f.nqtl = cast(t.nqtl as varchar)
           and f.effect = t.effect and f.h2 = t.h2 and f.rep = t.rep) group by s.population""",
)
def _(d):
    ids = G.slot_ids(manifest(d), d.marker_set_metadata, CV_MAF, CV_LD)
    left = G.delete_slots(d.mappings, ids, "mapping_id")
    return left.groupBy("population").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("mapping_id").alias("n_mappings")
    )


@query(
    "joi18_bundle",
    """select population as "group", maf, n_markers, n_tests, species from (
         select m.population, m.maf, m.n_markers, m.species, e.n as n_tests from marker_set_metadata m
         join (select marker_set_id, count(*) as n from markers group by marker_set_id) e
           on e.marker_set_id = m.marker_set_id) z""",
)
def _(d):
    sets_ = d.marker_set_metadata
    lists = sets_.select(F.col("population").alias("group"), "maf", "n_markers")
    tests = (
        d.markers.groupBy("marker_set_id")
        .agg(F.count(F.lit(1)).alias("n_tests"))
        .join(sets_, "marker_set_id")
        .select(F.col("population").alias("group"), "maf", "n_tests")
    )
    return G.bundle(lists, tests, sets_.select(F.col("population").alias("group"), "maf", "species"))
