"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuspark import schemas
from locuspark.operators import quality as X
from locuspark.operators.performance import designate
from locuspark.suite.assessment import rounded, stored_assessment
from locuspark.suite.detection import analyzed
from locuspark.suite.oracle import rnd
from locuspark.suite.registry import query

_SPECIES = "('c_elegans', 'c_briggsae', 'c_tropicalis')"
_SF = f"""select trim(grp) as "group", lower(trim(species)) as species, {rnd('ms_maf')} as ms_maf,
          {rnd('ms_ld')} as ms_ld"""


@query(
    "dq01_strainfile",
    f"""{_SF}, 'species' as "check" from strain_rows where lower(trim(species)) not in {_SPECIES}
        union all {_SF}, 'ms_maf' from strain_rows where not (ms_maf > 0 and ms_maf <= 0.5)
        union all {_SF}, 'ms_ld' from strain_rows where not (ms_ld > 0 and ms_ld < 1)""",
)
def _(d):
    groups = d.strain_rows.select(
        F.trim("grp").alias("group"), F.lower(F.trim("species")).alias("species"), "ms_maf", "ms_ld"
    )
    return rounded(X.dq_strainfile(groups, 0.05, 0.8))


@query(
    "dq02_unique_markers",
    """select mapping_id, CHROM, POS, count(*) as copies, 'unique_marker' as "check" from raw_rows
       group by mapping_id, CHROM, POS having count(*) > 1""",
)
def _(d):
    return X.dq_unique_markers(d.raw_rows)


@query(
    "dq03_p_range",
    """select mapping_id, marker, 'p_range' as "check" from mappings where P is not null and not (P > 0 and P <= 1)""",
)
def _(d):
    return X.dq_p_range(d.mappings).select("mapping_id", "marker", "check")


@query(
    "dq04_key_unique",
    """select ordinal, marker, count(*) as copies, 'unique_key' as "check" from raw_rows
       group by ordinal, marker having count(*) > 1""",
)
def _(d):
    return X.dq_unique(d.raw_rows, ["ordinal", "marker"])


@query(
    "dq05_id_format",
    """select tagged_id, marker, ordinal, 'id_format' as "check" from raw_rows
       where not regexp_full_match(tagged_id, '[0-9a-f]{20}')""",
)
def _(d):
    return X.dq_id_format(d.raw_rows.select("tagged_id", "marker", "ordinal"), "tagged_id")


@query(
    "dq06_arms",
    """select mapping_id, ordinal, marker, tagged_algorithm, tagged_pca, 'arms' as "check" from raw_rows
       where tagged_algorithm not in ('inbred', 'loco') or tagged_pca is null""",
)
def _(d):
    rows = d.raw_rows.select("mapping_id", "ordinal", "marker", "tagged_algorithm", "tagged_pca")
    return X.dq_arms(rows, "tagged_algorithm", "tagged_pca")


@query(
    "dq07_marker_counts",
    """select * from (
         select m.mapping_id, m.n_markers, r.n as n_rows, s.n_markers as n_set, k."check"
         from metadata m left join (select mapping_id, count(*) as n from mappings group by mapping_id) r
           on r.mapping_id = m.mapping_id
         left join marker_set_metadata s on s.marker_set_id = m.marker_set_id,
         (values ('partition_rows'), ('marker_set_size')) k("check")) z
       where ("check" = 'partition_rows' and n_markers is distinct from n_rows)
          or ("check" = 'marker_set_size' and n_markers is distinct from n_set)""",
)
def _(d):
    return X.dq_marker_counts(d.mappings, d.metadata, d.marker_set_metadata)


@query(
    "dq08_eigen_source",
    f"""select population, maf, {rnd('n_independent_tests', 6)} as n_independent_tests,
               {rnd('n * cast(0.6 as double) + cast(population = ' + "'cb.panel'" + ' as int)', 6)} as source_tests,
               'eigen_source' as "check"
        from (select s.*, (select count(*) from markers k where k.marker_set_id = s.marker_set_id) as n
              from marker_set_metadata s) z
        where n_independent_tests is distinct from n * cast(0.6 as double) + cast(population = 'cb.panel' as int)""",
)
def _(d):
    counted = d.markers.groupBy("marker_set_id").agg(F.count(F.lit(1)).alias("n"))
    lookup = counted.join(d.marker_set_metadata, "marker_set_id").select(
        "population",
        "maf",
        (F.col("n") * F.lit(0.6) + (F.col("population") == "cb.panel").cast("int")).alias("n_tests"),
    )
    return rounded(X.dq_eigen_source(d.marker_set_metadata, lookup), 6)


@query(
    "dq09_designations",
    """select strain_set_id, mode, type, threshold, nQTL, simREP, h2, QTL, designation, 'designation' as "check"
       from c_desig where designation is null""",
)
def _(d):
    return X.dq_designations(designate(stored_assessment(d))).select(
        "strain_set_id", "mode", "type", "threshold", "nQTL", "simREP", "h2", "QTL", "designation", "check"
    )


@query(
    "dq10_untested_causal",
    """select strain_set_id, mode, type, threshold, QTL, 'untested_causal' as "check" from c_assess
       where Simulated and log10p is null and significant is not null""",
)
def _(d):
    return X.dq_untested_causal(stored_assessment(d)).select(
        "strain_set_id", "mode", "type", "threshold", "QTL", "check"
    )


@query(
    "dq11_causal_off_markers",
    """select c.trait_id, c.QTL, c.CHROM, c.POS, 'off_marker' as "check"
       from causal_variants c join traits t on t.trait_id = c.trait_id
       where not exists (select 1 from markers k where k.marker_set_id = t.marker_set_id and k.marker = c.QTL)""",
)
def _(d):
    return X.dq_causal_off_markers(d.causal_variants, d.traits, d.markers).select(
        "trait_id", "QTL", "CHROM", "POS", "check"
    )


@query(
    "dq12_phenotypes_and_qtl",
    r"""select mapping_id, ordinal, 'phenotype' as "check" from raw_rows where P is null
        union all select mapping_id, ordinal, 'qtl_name' from raw_rows
        where not regexp_full_match(tagged_qtl, '[^:]+:[0-9]+')""",
)
def _(d):
    rows = d.raw_rows.withColumn("phenotype", F.col("P"))
    keys = ["mapping_id", "ordinal", "check"]
    return X.dq_phenotypes(rows).select(*keys).unionByName(
        X.dq_qtl_names(rows, "tagged_qtl").select(*keys)
    )


@query(
    "dq13_chromosomes",
    """select CHROM, 'only_first' as "check" from (select CHROM from raw_rows except select CHROM from c_assess) a
       union all select CHROM, 'only_second' from (select CHROM from c_assess
         except select CHROM from raw_rows) b""",
)
def _(d):
    return X.dq_chromosomes(d.raw_rows, stored_assessment(d))


_DECLARED = ("markers", "mappings", "metadata", "genotypes", "phenotypes", "causal_variants")


# The derived metadata has no processed_at column, which is the one deviation.
@query(
    "dq14_schema",
    " union all ".join(
        f"""select '{t}' as table_name, count(*) as n_rows,
                   {"'processed_at'" if t == 'metadata' else "''"} as deviating from {t}"""
        for t in _DECLARED
    ),
)
def _(d):
    tables = {name: (d.table(name), schemas.TABLES[name]) for name in _DECLARED}
    found = X.dq_schema(d.spark, tables).groupBy("table_name").agg(
        F.array_join(F.sort_array(F.collect_list("column_name")), ",").alias("deviating")
    )
    counts = None
    for name, (df, _schema) in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(found, "table_name", "left").fillna("", ["deviating"])


@query(
    "dq15_significant_share",
    f"""select mapping_id, method as sig_threshold_method, {rnd('coalesce(sum(significant), 0) / count(*)')} as share,
               'significant_share' as "check"
        from a_flag group by mapping_id, method having coalesce(sum(significant), 0) / count(*) > 0.04""",
)
def _(d):
    return rounded(X.dq_significant_share(analyzed(d), 0.04))
