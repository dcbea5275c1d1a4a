"""Identifiers, names, labels and other column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuspark import schemas
from locuspark.functions import (
    algorithm_label,
    eigen_name,
    mapping_id,
    marker_set_id,
    normalize_algorithm,
    normalize_species,
    output_name,
    parse_effect,
    parse_eigen_name,
    parse_mapping_name,
    parse_result_name,
    recode_gt,
    release_id,
    trait_id,
    with_ids,
)
from locuspark.operators import genotype as G
from locuspark.operators import grid
from locuspark.operators import queries as Q
from locuspark.suite.assessment import rounded
from locuspark.suite.oracle import rnd
from locuspark.suite.registry import query

_MS = (
    "concat('v=2|population=', lower(trim(population)), '|maf=', printf('%.10f', maf), '|species=', "
    "lower(trim(species)), '|vcf_release_id=', vcf_release_id, '|ms_ld=', printf('%.10f', ms_ld))"
)
_TR = (
    "concat('v=2|parent=', msid, '|nqtl=', nqtl, '|effect=', lower(trim(effect)), '|rep=', rep, '|h2=', "
    "printf('%.10f', h2), '|cv_maf_effective=', printf('%.10f', cv_maf_effective), '|cv_ld=', "
    "printf('%.10f', cv_ld))"
)
_MP = (
    "concat('v=1|parent=', trid, '|algorithm=', lower(trim(algorithm)), '|pca=', "
    "case when pca then 'TRUE' else 'FALSE' end)"
)


def _id(text: str) -> str:
    return f"substring(sha256({text}), 1, 20)"


_CHAIN = f"""i1 as (select *, {_MS} as ms_s, {_id(_MS)} as msid from id_rows),
 i2 as (select *, {_TR} as tr_s, {_id(_TR)} as trid from i1)"""


@query(
    "sca02_marker_set_id",
    f"with {_CHAIN} select l_orderkey, l_partkey, nqtl, msid as hash, ms_s as hash_string from i1",
)
def _(d):
    made = marker_set_id(
        F.col("population"), F.col("maf"), F.col("species"), F.col("vcf_release_id"), F.col("ms_ld")
    )
    return d.id_rows.withColumn("_id", made).select("l_orderkey", "l_partkey", "nqtl", "_id.*")


@query(
    "sca03_trait_id",
    f"with {_CHAIN} select l_orderkey, l_partkey, nqtl, trid as hash, tr_s as hash_string from i2",
)
def _(d):
    rows = with_ids(d.id_rows, include_mapping=False).withColumn(
        "_id",
        trait_id(
            F.col("marker_set_id"),
            F.col("nqtl"),
            F.col("effect"),
            F.col("rep"),
            F.col("h2"),
            F.col("cv_maf_effective"),
            F.col("cv_ld"),
        ),
    )
    return rows.select("l_orderkey", "l_partkey", "nqtl", "_id.*")


@query(
    "sca04_mapping_id",
    f"with {_CHAIN} select l_orderkey, l_partkey, nqtl, {_id(_MP)} as hash, {_MP} as hash_string from i2",
)
def _(d):
    rows = with_ids(d.id_rows, include_mapping=False).withColumn(
        "_id", mapping_id(F.col("trait_id"), F.col("algorithm"), F.col("pca"))
    )
    return rows.select("l_orderkey", "l_partkey", "nqtl", "_id.*")


@query(
    "sca05_id_chain",
    f"""with {_CHAIN} select l_orderkey, l_partkey, nqtl, msid as marker_set_id, trid as trait_id,
        {_id(_MP)} as mapping_id from i2""",
)
def _(d):
    return with_ids(d.id_rows).select(
        "l_orderkey", "l_partkey", "nqtl", "marker_set_id", "trait_id", "mapping_id"
    )


_MAPPING_RE = (
    r"^(\d+)_(\d+)_([0-9.]+)_([0-9.]+)_([a-zA-Z]+)_(.+)_processed_LMM-EXACT-(INBRED|LOCO)(_PCA)?_mapping\.tsv$"
)
_RESULT_RE = (
    r"^(\d+)_(\d+)_([0-9.]+)_([0-9.]+)_([a-zA-Z]+)_(.+)_lmm-exact_(inbred|loco)_(pca|nopca)$"
)


def _fields(text: str, pattern: str, yes: str) -> str:
    hit = f"regexp_matches({text}, '{pattern}')"
    kinds = ["int", "int", "double", "double", "varchar", "varchar", "varchar"]
    names = ["nqtl", "rep", "h2", "maf", "effect", "population", "algorithm"]
    cols = [
        f"case when {hit} then cast(regexp_extract({text}, '{pattern}', {i + 1}) as {k}) end as {n}"
        for i, (n, k) in enumerate(zip(names, kinds))
    ]
    cols.append(f"case when {hit} then regexp_extract({text}, '{pattern}', 8) = '{yes}' end as pca")
    return ", ".join(cols)


@query(
    "sca06_mapping_name",
    rf"""select mapping_path, {_fields('t', _MAPPING_RE, '_PCA')} from (
          select mapping_path, regexp_replace(regexp_replace(regexp_replace(
                   regexp_replace(mapping_path, '^.*/', ''),
                   '_qtl_regions_reprocessed\.tsv$', '_mapping.tsv'),
                   '_mapping_reprocessed\.tsv$', '_mapping.tsv'), '_reprocessed\.tsv$', '.tsv') as t
          from name_rows) z""",
)
def _(d):
    return d.name_rows.withColumn("_p", parse_mapping_name(F.col("mapping_path"))).select(
        "mapping_path", "_p.*"
    )


@query(
    "sca06_result_name",
    rf"""select result_path, {_fields('t', _RESULT_RE, 'pca')} from (
          select result_path, regexp_replace(regexp_replace(result_path, '^.*/', ''), '\.[^.]*$', '') as t
          from name_rows) z""",
)
def _(d):
    return d.name_rows.withColumn("_p", parse_result_name(F.col("result_path"))).select(
        "result_path", "_p.*"
    )


@query(
    "sca07_eigen_name",
    r"""select l_orderkey, l_partkey, eigen_file, case when ok then regexp_extract(eigen_file, p, 1) end as population,
              case when ok then cast(regexp_extract(eigen_file, p, 2) as double) end as maf,
              case when ok then concat(regexp_extract(eigen_file, p, 1), '_',
                   cast(cast(regexp_extract(eigen_file, p, 2) as double) as varchar),
                   '_total_independent_tests.txt') end as rebuilt
       from (select *, '^(.+)_([0-9.]+)_total_independent_tests\.txt$' as p,
                    regexp_matches(eigen_file, '^(.+)_([0-9.]+)_total_independent_tests\.txt$') as ok
             from name_rows) z""",
)
def _(d):
    return (
        d.name_rows.withColumn("_p", parse_eigen_name(F.col("eigen_file")))
        .select("l_orderkey", "l_partkey", "eigen_file", "_p.population", "_p.maf")
        .withColumn("rebuilt", eigen_name(F.col("population"), F.col("maf")))
    )


@query(
    "sca08_output_name",
    r"""select mapping_path, concat(regexp_replace(regexp_replace(mapping_path, '^.*/', ''), '\.tsv$', ''),
              '_reprocessed.tsv') as output_name from name_rows""",
)
def _(d):
    return d.name_rows.select("mapping_path", output_name(F.col("mapping_path")).alias("output_name"))


@query(
    "sca09_species",
    "select l_orderkey, l_partkey, nqtl, lower(trim(species)) as species from id_rows",
)
def _(d):
    return d.id_rows.select(
        "l_orderkey", "l_partkey", "nqtl", normalize_species(F.col("species")).alias("species")
    )


@query(
    "sca10_release_id",
    r"""select vcf, case when regexp_matches(vcf, '^\d{8}$') then vcf
              else regexp_extract(regexp_replace(vcf, '^.*/', ''), '(\d{8})', 1) end as release from name_rows""",
)
def _(d):
    return d.name_rows.select("vcf", release_id(F.col("vcf")).alias("release"))


@query(
    "sca12_recode_genotype",
    """select l_orderkey, l_partkey, l_linenumber, case when gt in ('0|0', '0/0') then cast(-1 as double)
              when gt in ('1|1', '1/1') then cast(1 as double) end as allele from name_rows""",
)
def _(d):
    return d.name_rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", recode_gt(F.col("gt")).alias("allele")
    )


@query(
    "sca13_rename_chromosome",
    """select l_orderkey, l_partkey, l_linenumber, case l_linenumber when 1 then '1' when 2 then '2' when 3 then '3'
              when 4 then '4' when 5 then '5' when 6 then '6' else '7' end as CHROM from name_rows""",
)
def _(d):
    contigs = d.spark.createDataFrame(
        list(enumerate("I II III IV V X MtDNA".split(), 1)), "ordinal int, contig string"
    )
    named = d.name_rows.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.element_at(
            F.split(F.lit("I,II,III,IV,V,X,MtDNA"), ","), F.col("l_linenumber").cast("int")
        ).alias("CHROM"),
    )
    return G.rename_chrom(named, contigs)


@query(
    "sca14_effect_spec",
    """select l_orderkey, l_partkey, l_linenumber, case when effect_spec = 'gamma' then 'gamma'
              when contains(effect_spec, '-') then 'uniform' end as family,
              case when contains(effect_spec, '-') then cast(split_part(effect_spec, '-', 1) as double) end as lo,
              case when contains(effect_spec, '-') then cast(split_part(effect_spec, '-', 2) as double) end as hi
       from name_rows""",
)
def _(d):
    return d.name_rows.withColumn("_p", parse_effect(F.col("effect_spec"))).select(
        "l_orderkey", "l_partkey", "l_linenumber", "_p.family", "_p.lo", "_p.hi"
    )


@query(
    "sca15_algorithm_label",
    """select l_orderkey, l_partkey, l_linenumber,
              concat(algorithm, case when pca then '_PCA_' else '_noPCA_' end, 'BF') as label from name_rows""",
)
def _(d):
    label = algorithm_label(F.col("algorithm"), F.col("pca"), F.lit("BF"))
    return d.name_rows.select("l_orderkey", "l_partkey", "l_linenumber", label.alias("label"))


@query(
    "sca16_normalize_algorithm",
    """select l_orderkey, l_partkey, l_linenumber,
              regexp_replace(upper(algorithm_id), '^LMM-EXACT-', '') as label from name_rows""",
)
def _(d):
    return d.name_rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", normalize_algorithm(F.col("algorithm_id")).alias("label")
    )


@query(
    "sca19_effective_cv_maf",
    f"""select l_orderkey, l_partkey, nqtl, {rnd('maf')} as ms_maf, cast(0.05 as double) as cv_maf_effective,
               cast(0.05 as double) > maf as cv_maf_above from id_rows""",
)
def _(d):
    groups = d.id_rows.select("l_orderkey", "l_partkey", "nqtl", F.col("maf").alias("ms_maf"))
    return rounded(grid.effective_cv_maf(groups, 0.05))


@query(
    "sca20_conform",
    "select marker_set_id, marker, CHROM, POS, A1, A2, cast(POS as varchar) as extra from markers",
)
def _(d):
    loose = d.markers.withColumns({"POS": F.col("POS").cast("string"), "extra": F.col("POS").cast("string")})
    return Q.conform(loose, schemas.MARKERS).select(*schemas.MARKERS.names, "extra")


@query(
    "sca21_single_trait",
    "select min(effect) as trait, min(effect) <> max(effect) as several from id_rows",
)
def _(d):
    return Q.single_trait(d.id_rows.select(F.col("effect").alias("trait")))
