"""Text sources, stored tables and sinks.

Each reader runs on files that Spark first writes from the domain tables, so
the whole table passes through the file format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark import schemas
from locuspark.operators import regions as R
from locuspark.operators.intervals import detect
from locuspark.session import make_folder, scratch_dir, stage
from locuspark.sinks import database as DB
from locuspark.sinks import text as TX
from locuspark.sinks.plink import write_bed
from locuspark.sources import catalog, genotypes, params, plink, results
from locuspark.suite.assessment import rounded, stored_assessment
from locuspark.suite.detection import analyzed, arm_thresholds
from locuspark.suite.domain import ALPHA, CI_SIZE, SNP_GROUPING, Domain
from locuspark.suite.oracle import rnd
from locuspark.suite.registry import query


def text_file(d: Domain, name: str, lines: DataFrame, header: str | None = None) -> str:
    """Write one text column below a new folder whose name ends in ``name``."""
    path = scratch_dir(d.spark, "text") + "/" + name
    if header is not None:
        head = lines.limit(1).select(F.lit(header).alias("value"))
        head.coalesce(1).write.mode("append").text(path)
    lines.write.mode("append").text(path)
    return path


def cells(*names: str, sep: str = "\t", null: str = "NA"):
    return F.concat_ws(
        sep, *[F.coalesce(F.col(n).cast("string"), F.lit(null)) for n in names]
    ).alias("value")


_GWA = f"""select marker, CHROM, POS, 'A' as A1, 'G' as A2, {rnd('AF1')} as AF1, {rnd('BETA')} as BETA,
   {rnd('SE')} as SE, {rnd('P', 12)} as P, mapping_id as tag from (
   select s.*, split_part(s.marker, ':', 1) as CHROM, cast(split_part(s.marker, ':', 2) as int) as POS from mappings s) z"""


@query(
    "src01_read_gwa",
    f"""select marker, CHROM, POS, A1, A2, AF1, BETA, SE, P from ({_GWA}) y""",
)
def _(d):
    rows = d.mappings.join(d.metadata.select("mapping_id", "algorithm"), "mapping_id").withColumns(
        {
            "CHROM": F.substring_index("marker", ":", 1),
            "POS": F.substring_index("marker", ":", -1),
            "A1": F.lit("A"),
            "A2": F.lit("G"),
            "N": F.lit(96),
        }
    )
    fast = rows.where(F.col("algorithm") == "inbred")
    loco = rows.where(F.col("algorithm") == "loco")
    paths = [
        text_file(
            d,
            "x.fastGWA",
            fast.select(cells("CHROM", "marker", "POS", "A1", "A2", "N", "AF1", "BETA", "SE", "P")),
            "CHR\tSNP\tPOS\tA1\tA2\tN\tAF1\tBETA\tSE\tP",
        ),
        text_file(
            d,
            "x.mlma",
            loco.select(cells("CHROM", "marker", "POS", "A1", "A2", "AF1", "BETA", "SE", "P")),
            "Chr\tSNP\tbp\tA1\tA2\tFreq\tb\tse\tp",
        ),
    ]
    return rounded(results.read_gwa(d.spark, paths).drop("source_file"), P=12)


@query("src02_read_bim", "select marker, CHROM, POS, A1, A2 from markers")
def _(d):
    rows = d.markers.withColumns({"id": F.lit("snp"), "cm": F.lit(0)})
    path = text_file(d, "x.bim", rows.select(cells("CHROM", "id", "cm", "POS", "A1", "A2")))
    return plink.read_bim(d.spark, path)


@query(
    "src03_read_fam",
    """select strain as fid, trait_id as iid, '0' as pid, '0' as mid, '0' as sex, cast(-9 as double) as pheno
       from phenotypes""",
)
def _(d):
    rows = d.phenotypes.withColumns({"z": F.lit("0"), "m": F.lit("-9")})
    path = text_file(
        d, "x.fam", rows.select(cells("strain", "trait_id", "z", "z", "z", "m", sep="  "))
    )
    return plink.read_fam(d.spark, path)


@query("src04_read_phen", f"select strain, {rnd('phenotype')} as phenotype from phenotypes")
def _(d):
    path = text_file(d, "x.phen", d.phenotypes.select(cells("strain", "strain", "phenotype", sep=" ")))
    return rounded(plink.read_phen(d.spark, path))


@query(
    "src05_read_par",
    f"""select QTL, CHROM, POS, RefAllele, {rnd('Frequency')} as Frequency, {rnd('Effect')} as Effect
        from causal_variants""",
)
def _(d):
    rows = d.causal_variants.select(cells("QTL", "RefAllele", "Frequency", "Effect"))
    path = text_file(d, "x.par", rows, "QTL\tRefAllele\tFrequency\tEffect")
    return rounded(plink.read_par(d.spark, path))


@query(
    "src06_read_causal_genotypes",
    "select trait_id, QTL, CHROM, POS, strain, allele from causal_genotypes",
)
def _(d):
    base = scratch_dir(d.spark, "causal-genotypes")
    rows = d.causal_genotypes.select("trait_id", "QTL", "strain", "allele")
    rows.write.partitionBy("trait_id").csv(base, sep="\t", header=True, nullValue="NA")
    return genotypes.read_causal_genotypes_tsv(d.spark, base)


_WIDE = """select k.CHROM, k.POS, n.strain, g.allele from (select distinct CHROM, POS from genotypes
   where marker_set_id = (select min(marker_set_id) from genotypes)) k
   cross join (select concat('S', n_nationkey) as strain from nation) n
   left join (select * from genotypes where marker_set_id = (select min(marker_set_id) from genotypes)) g
     on g.CHROM = k.CHROM and g.POS = k.POS and g.strain = n.strain"""


def strain_names(d: Domain) -> list[str]:
    """Supplier nations: a table of fixed size."""
    nations = d.source("nation").select("n_nationkey").orderBy("n_nationkey").collect()
    return [f"S{row[0]}" for row in nations]


def wide_genotypes(d: Domain) -> DataFrame:
    first = d.genotypes.agg(F.min("marker_set_id")).first()[0]
    one = d.genotypes.where(F.col("marker_set_id") == first)
    wide = one.groupBy("CHROM", "POS").pivot("strain", strain_names(d)).agg(F.first("allele"))
    return wide.withColumns({"REF": F.lit("A"), "ALT": F.lit("G")})


@query("src07_read_genotype_matrix", _WIDE)
def _(d):
    path = scratch_dir(d.spark, "matrix")
    wide_genotypes(d).write.csv(path, sep="\t", header=True, nullValue="NA")
    return genotypes.read_genotype_matrix_tsv(d.spark, path)


def eigen_files(d: Domain) -> str:
    """A test-count file per supplier, named after it; every third name cannot be parsed."""
    base = scratch_dir(d.spark, "eigen")
    rows = d.source("supplier").select(
        F.concat(
            F.lit("pop"),
            "s_suppkey",
            F.when(F.col("s_suppkey") % 3 == 0, "_x").otherwise("_0.05"),
            F.lit("_total_independent_tests.txt"),
        ).alias("name"),
        F.concat(F.col("s_acctbal").cast("string"), F.lit("\nrest")).alias("value"),
    )
    TX.write_files(rows, base).write.format("noop").mode("overwrite").save()
    return base


@query("src08_read_eigen", f"select {rnd('s_acctbal')} as n_tests from supplier")
def _(d):
    return rounded(params.read_eigen(d.spark, eigen_files(d)).select("n_tests"))


@query(
    "src09_eigen_lookup",
    f"""select case when s_suppkey % 3 = 0 then null else concat('pop', s_suppkey) end as population,
               case when s_suppkey % 3 = 0 then null else cast(0.05 as double) end as maf,
               {rnd('s_acctbal')} as n_tests, concat('pop', s_suppkey, case when s_suppkey % 3 = 0 then '_x' else '_0.05' end,
               '_total_independent_tests.txt') as source_file,
               case when s_suppkey % 3 = 0 then 'unparseable name' end as problem from supplier""",
)
def _(d):
    return rounded(params.build_eigen_lookup(d.spark, eigen_files(d)))


@query(
    "src10_read_mapping_tsv",
    f"select mapping_id, CHROM, marker, POS, {rnd('P', 12)} as P from raw_rows",
)
def _(d):
    path = scratch_dir(d.spark, "mapping")
    d.raw_rows.select("mapping_id", "CHROM", "marker", "POS", "P").write.csv(
        path, sep="\t", header=True, nullValue="NA"
    )
    return rounded(results.read_mapping_tsv(d.spark, path), P=12)


@query(
    "src11_read_strainfile",
    f"""select trim(grp) as "group", lower(trim(species)) as species, vcf, {rnd('ms_maf')} as ms_maf,
               {rnd('ms_ld')} as ms_ld, strains, len(string_split(strains, ',')) as n_strains from strain_rows""",
)
def _(d):
    path = scratch_dir(d.spark, "strainfile")
    d.strain_rows.withColumnsRenamed({"grp": "population", "ms_maf": "maf"}).write.csv(
        path, sep="\t", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    out = params.read_strainfile(d.spark, path)
    return rounded(out.withColumn("n_strains", F.size("strain_list")).drop("strain_list"))


_MANIFEST = """select session, task_hash, cast(attempt as int) as attempt, species, grp as "group", maf, nqtl,
       effect, h2, rep, mode, type, exit_code as "exit" from outcomes"""


def manifest_rows(d: Domain) -> DataFrame:
    return d.outcomes.withColumnsRenamed({"grp": "group", "exit_code": "exit"})


@query("src12_read_manifest", _MANIFEST)
def _(d):
    path = scratch_dir(d.spark, "manifest")
    TX.write_manifest(manifest_rows(d), path)
    return params.read_replay_manifest(d.spark, path).drop("max_retries")


@query(
    "snk08_write_manifest",
    """select session, task_hash, cast(attempt as varchar) as attempt, cast(null as varchar) as max_retries, species,
              grp as "group", cast(maf as varchar) as maf, nqtl, effect, cast(h2 as varchar) as h2,
              cast(rep as varchar) as rep, mode, type, cast(exit_code as varchar) as "exit", 'late' as aaa, task_hash as zzz
       from outcomes""",
)
def _(d):
    path = scratch_dir(d.spark, "manifest")
    rows = manifest_rows(d).withColumns({"zzz": F.col("task_hash"), "aaa": F.lit("late")})
    TX.write_manifest(rows, path)
    return d.spark.read.csv(path, sep="\t", header=True)


@query(
    "src13_read_failures",
    """select session, task_hash, attempt, grp as "group", exit_code as "exit" from outcomes
       where session = 'this_run' and exit_code <> 0""",
)
def _(d):
    path = scratch_dir(d.spark, "failures")
    failed = manifest_rows(d).where(F.col("exit") != 0)
    failed.write.json(path)
    out = params.read_failures(d.spark, path, "this_run", one_per_file=False)
    return out.select("session", "task_hash", "attempt", "group", F.col("exit").cast("int").alias("exit"))


@query(
    "src19_read_vcf",
    """select v.CHROM, v.POS, v.ID, v.REF, v.ALT, concat('S', n.n_nationkey) as strain,
              case when c.code is null then './.' when c.code < 6 then '0/0' when c.code < 11 then '1|1'
                   when c.code = 11 then '0/1' else './.' end as gt
       from d_variants v cross join nation n left join d_calls c on c.pk = v.pk and c.nk = n.n_nationkey""",
)
def _(d):
    return genotypes.read_vcf(d.spark, vcf_file(d))


@query(
    "src19_read_block_gzip",
    """select v.CHROM, v.POS, v.ID, v.REF, v.ALT, concat('S', n.n_nationkey) as strain,
              case when c.code is null then './.' when c.code < 6 then '0/0' when c.code < 11 then '1|1'
                   when c.code = 11 then '0/1' else './.' end as gt
       from d_variants v cross join nation n left join d_calls c on c.pk = v.pk and c.nk = n.n_nationkey""",
)
def _(d):
    """The variants as block-gzip files, one per part of the table, each read in ranges."""
    lines = d.spark.read.text(vcf_file(d))
    header = [r["value"] for r in lines.where(F.col("value").startswith("#")).collect()]
    folder = scratch_dir(d.spark, "variants")
    stage(TX.write_block_gzip(lines.where(~F.col("value").startswith("#")), folder, header), "variant-files")
    return genotypes.read_vcf(d.spark, folder)


CONTIGS = ("I", "II", "III", "IV", "V", "X", "MtDNA")


def vcf_file(d: Domain) -> str:
    """All variants as a variant file: header lines, then one line per part."""
    names = strain_names(d)
    gt = F.expr(
        "case when code < 6 then '0/0' when code < 11 then '1|1' when code = 11 then '0/1' else './.' end"
    )
    calls = d.table("d_calls").select("pk", F.concat(F.lit("S"), "nk").alias("strain"), gt.alias("gt"))
    wide = calls.groupBy("pk").pivot("strain", names).agg(F.first("gt"))
    call = [F.concat(F.coalesce(F.col(n), F.lit("./.")), F.lit(":9")) for n in names]
    body = d.table("d_variants").join(wide, "pk", "left").select(
        F.concat_ws("\t", "CHROM", "POS", "ID", "REF", "ALT", F.lit(".\tPASS\t.\tGT:DP"), *call).alias(
            "value"
        )
    )
    header = [f"##contig=<ID={c},length=100000000>" for c in CONTIGS]
    header.append("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(names))
    return text_file(d, "x.vcf", body, "\n".join(["##fileformat=VCFv4.2", *header]))


@query(
    "src19_read_contigs",
    """select contig, cast(row_number() over (order by m) as int) as ordinal from (
         select case CHROM when 'MtDNA' then 'MtDNA' else CHROM end as contig,
                case CHROM when 'I' then 1 when 'II' then 2 when 'III' then 3 when 'IV' then 4 when 'V' then 5
                     when 'X' then 6 else 7 end as m from (select distinct CHROM from d_variants) v) z""",
)
def _(d):
    return genotypes.read_contigs(d.spark, vcf_file(d))


@query(
    "src20_read_bed",
    """select k.CHROM, k.POS, n.strain, g.allele from (select distinct marker_set_id, CHROM, POS from genotypes) k
       cross join (select concat('S', n_nationkey) as strain from nation) n
       left join genotypes g on g.marker_set_id = k.marker_set_id and g.CHROM = k.CHROM and g.POS = k.POS and g.strain = n.strain""",
)
def _(d):
    """A fileset per marker set and chromosome, written and read again."""
    folder = scratch_dir(d.spark, "filesets")
    stage(write_bed(d.genotypes, strain_names(d), folder, ("marker_set_id", "CHROM")), "filesets")
    return plink.read_bed(d.spark, folder)


def _accounting(name, ending, fields, header, wrong, lines_of, read):
    """A query of what a reader makes of every line of a file that holds malformed and blank ones.

    Of the lines made from ``fields`` (SQL), those whose hash begins with 3 are
    cut to two fields, with 7 have a word in the place ``wrong``, and with 5 are
    followed by a blank line.
    """
    text = f"concat_ws(' ', {fields[0]})"
    spoilt = "x in ('3', '7')"

    @query(
        name,
        f"""with l as (select substr(sha256({text}), 1, 1) as x from {fields[1]})
            select count(*) + count(*) filter (x = '5') + {int(bool(header))} as n_lines, {int(bool(header))} as n_header,
                   count(*) filter (x = '5') as n_blank, count(*) filter (not {spoilt}) as n_rows,
                   count(*) filter ({spoilt}) as n_rejected, count(*) filter (not {spoilt}) as n_read,
                   count(*) filter ({spoilt}) as n_rejects from l""",
    )
    def _(d):
        value, x = F.col("value"), F.col("x")
        named = d.table(fields[1]).select(F.expr(text).alias("value")).withColumn("x", F.substring(F.sha2(value, 256), 1, 1))
        cells = F.split(value, " ")
        word = F.concat_ws(" ", F.slice(cells, 1, wrong - 1), F.lit("word"), F.slice(cells, wrong + 1, 20))
        spoil = F.when(x == "3", F.concat_ws(" ", F.slice(cells, 1, 2))).when(x == "7", word).otherwise(value)
        spoilt_lines = named.select("x", spoil.alias("value"))
        more = F.when(x == "5", F.array(value, F.lit("  "))).otherwise(F.array(value))
        path = text_file(d, "x" + ending, spoilt_lines.select(F.explode(more).alias("value")), header)
        lines = lines_of(d.spark, path)
        counts = lines.account().drop("source_file").groupBy().sum()
        counts = counts.select(*[F.col(f"sum({c})").alias(c) for c in ("n_lines", "n_header", "n_blank", "n_rows", "n_rejected")])
        read_ = read(d.spark, path, bad="skip").agg(F.count(F.lit(1)).alias("n_read"))
        rejects = lines.rejects().where("line > 0").agg(F.count(F.lit(1)).alias("n_rejects"))
        one = F.lit(1).alias("one")
        return counts.select("*", one).join(read_.select("*", one), "one").join(rejects.select("*", one), "one").drop("one")


_GWA_TEXT = "split_part(marker, ':', 1), marker, split_part(marker, ':', 2), 'A', 'G', '96', '0.1', 'nan', '0.3', '1e-9', mapping_id"
_accounting(
    "src01_row_accounting", ".fastGWA", (_GWA_TEXT, "mappings"), "CHR SNP POS A1 A2 N AF1 BETA SE P", 3, results.gwa_lines, results.read_gwa
)
_accounting(
    "src02_row_accounting", ".bim", ("CHROM, marker, '0', split_part(marker, ':', 2), A1, A2, marker_set_id", "markers"), None, 4, plink.bim_lines, plink.read_bim
)
_accounting("src03_row_accounting", ".fam", ("strain, trait_id, '0', '0', '0', '-9'", "phenotypes"), None, 6, plink.fam_lines, plink.read_fam)
_accounting("src04_row_accounting", ".phen", ("strain, trait_id, 'NA'", "phenotypes"), None, 3, plink.phen_lines, plink.read_phen)
_accounting(
    "src05_row_accounting", ".par", ("QTL, RefAllele, '0.5', '-1.5', trait_id", "causal_variants"), "QTL RefAllele Frequency Effect", 3, plink.par_lines, plink.read_par
)


@query(
    "src20_decode_packed",
    """select v.CHROM, v.POS, concat('S', n.n_nationkey) as strain,
              case when c.code < 6 then cast(-1 as double) when c.code >= 6 and c.code < 11 then cast(1 as double) end as allele
       from d_variants v join (select distinct pk from d_calls) k on k.pk = v.pk
       cross join nation n left join d_calls c on c.pk = v.pk and c.nk = n.n_nationkey""",
)
def _(d):
    names = strain_names(d)
    width = (len(names) + 3) // 4
    # Two bits per strain, low bits first; strains without a call get the missing code.
    code = F.expr("case when code < 6 then 0 when code < 11 then 3 when code = 11 then 2 else 1 end")
    bits = d.table("d_calls").select(
        "pk",
        F.floor(F.col("nk") / 4).cast("int").alias("byte"),
        ((code - 1) * F.pow(F.lit(4), F.col("nk") % 4).cast("int")).alias("delta"),
    )
    # 0x55 is "missing" for all four strains of a byte.
    per_byte = bits.groupBy("pk", "byte").agg((F.sum("delta") + 0x55).alias("value"))
    hexed = per_byte.groupBy("pk").pivot("byte", list(range(width))).agg(
        F.first(F.lpad(F.hex("value"), 2, "0"))
    )
    packed = hexed.select(
        "pk",
        F.unhex(
            F.concat(*[F.coalesce(F.col(f"`{i}`"), F.lit("55")) for i in range(width)])
        ).alias("bytes"),
    ).join(d.table("d_variants").select("pk", "CHROM", "POS"), "pk")
    return plink.decode_packed(packed, names)


@query(
    "src21_read_values",
    "select cast(p_size as varchar) as value from part union all select p_brand from part",
)
def _(d):
    part = d.source("part")
    lines = part.select(F.concat(F.lit("  "), F.col("p_size").cast("string"), F.lit(" \n\n")).alias("value"))
    path = text_file(d, "values.txt", lines)
    inline = part.select(F.concat(F.lit(" "), "p_brand", F.lit(",, ")).alias("list"))
    return params.read_values(d.spark, path).unionByName(params.parse_values(inline, "list"))


# ---- stored database ------------------------------------------------------


# The parts of a database by the calls that write them.
_PARTS = {
    "markers": lambda d, base: DB.write_marker_sets(d.markers, d.marker_set_metadata, base),
    "genotypes": lambda d, base: DB.write_genotypes(d.genotypes, base),
    "traits": lambda d, base: DB.write_traits(d.traits, d.causal_variants, d.phenotypes, d.causal_genotypes, base),
    "mappings": lambda d, base: DB.write_mappings(d.mappings, base),
    "metadata": lambda d, base: DB.write_sidecars(d.metadata, base),
}
_written: set[tuple[str, str]] = set()


def database(d: Domain, *parts: str) -> str:
    """A database with these parts, or with all of them; each is written once per session."""
    base = d.kept("database", lambda path: make_folder(d.spark, path))
    for part in parts or _PARTS:
        if (base, part) not in _written:
            _PARTS[part](d, base)
            _written.add((base, part))
    return base


@query(
    "src14_open_db",
    f"""select s.population, s.mapping_id, s.marker, {rnd('s.P', 12)} as P, m.algorithm, k.POS
        from mappings s join metadata m on m.mapping_id = s.mapping_id
        join markers k on k.marker_set_id = m.marker_set_id and k.marker = s.marker""",
)
def _(d):
    catalog.open_db(d.spark, database(d, "markers", "mappings", "metadata"))
    joined = d.spark.sql(
        """select s.population, s.mapping_id, s.marker, s.P, m.algorithm, k.POS
           from mappings s join metadata m on m.mapping_id = s.mapping_id
           join markers k on k.marker_set_id = m.marker_set_id and k.marker = s.marker"""
    )
    return rounded(joined, P=12)


@query(
    "src16_read_by_key",
    """select CHROM, POS, strain, allele, marker_set_id from genotypes
       where marker_set_id = (select min(marker_set_id) from genotypes)""",
)
def _(d):
    first = d.genotypes.agg(F.min("marker_set_id")).first()[0]
    return catalog.read_by_key(d.spark, database(d, "genotypes"), "genotypes", "marker_set_id", first)


@query(
    "src17_marker_set_metadata",
    f"""select marker_set_id, population, species, vcf_release_id, n_markers,
               {rnd('n_independent_tests', 6)} as n_independent_tests from marker_set_metadata""",
)
def _(d):
    return rounded(
        catalog.read_or_empty(d.spark, database(d, "markers"), "marker_set_metadata").select(
            "marker_set_id", "population", "species", "vcf_release_id", "n_markers", "n_independent_tests"
        ),
        6,
    )


@query(
    "snk01_write_mappings",
    f"""select population, mapping_id, marker, {rnd('AF1')} as AF1, {rnd('BETA')} as BETA, {rnd('SE')} as SE,
               {rnd('P', 12)} as P from mappings""",
)
def _(d):
    base = scratch_dir(d.spark, "database")
    DB.write_mappings(d.mappings.withColumn("BETA", F.lit(0.0)), base)
    # A second write replaces the partitions it brings and nothing else.
    DB.write_mappings(d.mappings, base)
    return rounded(catalog.read_table(d.spark, base, "mappings"), P=12)


@query(
    "snk02_write_sidecars",
    "select mapping_id, trait_id, marker_set_id, population, nqtl, rep, h2, algorithm, pca, n_markers from metadata",
)
def _(d):
    return catalog.read_table(d.spark, database(d, "metadata"), "metadata").select(
        "mapping_id", "trait_id", "marker_set_id", "population", "nqtl", "rep", "h2", "algorithm", "pca", "n_markers"
    )


@query(
    "snk03_write_marker_sets", "select marker_set_id, marker, CHROM, POS, A1, A2 from markers"
)
def _(d):
    base = scratch_dir(d.spark, "database")
    doubled = d.markers.unionByName(d.markers)
    DB.write_marker_sets(doubled, d.marker_set_metadata, base)
    changed = d.markers.withColumn("A1", F.lit("N"))
    DB.write_marker_sets(changed, d.marker_set_metadata, base, overwrite=False)
    return catalog.read_table(d.spark, base, "markers")


@query(
    "snk04_write_genotypes", "select marker_set_id, CHROM, POS, strain, allele from genotypes"
)
def _(d):
    return catalog.read_table(d.spark, database(d, "genotypes"), "genotypes")


@query(
    "snk05_write_traits",
    f"""select t.trait_id, t.nqtl, t.rep, t.h2, t.effect, p.strain, {rnd('p.phenotype')} as phenotype,
               (select count(*) from causal_variants c where c.trait_id = t.trait_id) as n_causal,
               (select count(*) from causal_genotypes g where g.trait_id = t.trait_id) as n_genotypes
        from traits t join phenotypes p on p.trait_id = t.trait_id""",
)
def _(d):
    read = {
        t: catalog.read_table(d.spark, database(d, "traits"), t)
        for t in ("traits", "phenotypes", "causal_variants", "causal_genotypes")
    }
    n = F.count(F.lit(1))
    causal = read["causal_variants"].groupBy("trait_id").agg(n.alias("n_causal"))
    geno = read["causal_genotypes"].groupBy("trait_id").agg(n.alias("n_genotypes"))
    out = (
        read["traits"]
        .select("trait_id", "nqtl", "rep", "h2", "effect")
        .join(read["phenotypes"], "trait_id")
        .join(causal, "trait_id", "left")
        .join(geno, "trait_id", "left")
        .fillna(0, ["n_causal", "n_genotypes"])
    )
    return rounded(out)


def result_tables(d: Domain) -> str:
    """Regions and summaries of one analysis, written once per session."""

    def build(base: str) -> None:
        thr = stage(arm_thresholds(d), "thresholds")
        peaked, peaks = detect(d.mappings, thr, CI_SIZE, SNP_GROUPING)
        DB.write_regions(
            R.region_records(R.regions_from_peaks(peaks), d.metadata, CI_SIZE, SNP_GROUPING), base
        )
        summary = R.summary_from_detection(d.mappings, thr, peaked).join(
            d.metadata.select("mapping_id", "population", "maf", "algorithm"), "mapping_id"
        )
        settings = {"ci_size": F.lit(CI_SIZE), "snp_grouping": F.lit(SNP_GROUPING)}
        DB.write_summary(summary.withColumns(settings), base)

    return d.kept("results", build)


_REGION = f"""select p.mapping_id, p.method as threshold_method, p.peak_id, p.CHROM, p.startPOS, p.peakPOS, p.endPOS,
   p.interval_size, cast(p.n_sig as int) as n_sig_markers, {rnd('p.max_log10p')} as max_log10p, p.peak_marker,
   {rnd('p.thr')} as sig_threshold_value, {CI_SIZE} as ci_size, {SNP_GROUPING} as snp_grouping, m.algorithm,
   m.population, m.maf from a_peaks p join metadata m on m.mapping_id = p.mapping_id"""


@query("snk06_write_regions", _REGION)
def _(d):
    return rounded(catalog.read_table(d.spark, result_tables(d), "qtl_regions"))


@query(
    "src18_read_regions",
    f"select * from ({_REGION}) z where population = 'ce.panel' and algorithm = 'loco'",
)
def _(d):
    out = catalog.read_or_empty(d.spark, result_tables(d), "qtl_regions")
    return rounded(
        out.where((F.col("population") == "ce.panel") & (F.col("algorithm") == "loco"))
    )


@query(
    "agg24_result_stats",
    """select (select count(*) from a_peaks) as n_regions,
              (select count(*) from (select distinct mapping_id, method from a_flag) z) as n_summary_rows,
              true as has_files, 0 as n_unreadable_files""",
)
def _(d):
    # The number of files depends on how the writer split the partitions.
    out = catalog.result_stats(d.spark, result_tables(d))
    return out.withColumn("n_region_files", F.col("n_region_files") > 0).withColumnRenamed("n_region_files", "has_files")


@query(
    "agg26_run_metadata",
    f"""select 'run1' as run_id, cast({ALPHA} as double) as alpha, {CI_SIZE} as ci_size, {SNP_GROUPING} as snp_grouping,
               cast((select count(distinct population) from metadata) as int) as n_populations,
               cast((select count(distinct mapping_id) from a_flag) as int) as n_mappings,
               cast((select count(*) from a_peaks where method = 'BF') as int) as n_qtl_bf,
               cast((select count(*) from a_peaks where method = 'EIGEN') as int) as n_qtl_eigen""",
)
def _(d):
    summary = catalog.read_or_empty(d.spark, result_tables(d), "analysis_summary")
    return DB.run_metadata(summary, "run1", ALPHA, CI_SIZE, SNP_GROUPING)


@query(
    "agg20_build_metadata",
    """select (select count(*) from metadata where rep < 4) as n_sidecars,
              (select count(distinct mapping_id) from metadata where rep < 4) as n_distinct_ids,
              (select count(distinct mapping_id) from mappings) as n_data,
              (select count(*) from metadata where rep >= 4) as n_orphans, false as fatal""",
)
def _(d):
    sidecars = d.metadata.where(F.col("rep") < 4)
    _metadata, _orphans, stats = DB.build_metadata(sidecars, d.mappings)
    return stats


@query(
    "agg20_orphans",
    """select mapping_id, count(*) as n_rows from mappings
       where mapping_id in (select mapping_id from metadata where rep >= 4) group by mapping_id""",
)
def _(d):
    return DB.build_metadata(d.metadata.where(F.col("rep") < 4), d.mappings)[1]


@query(
    "agg23_db_stats",
    """select (select count(distinct marker_set_id) from markers) as n_marker_sets,
              (select count(n_independent_tests) from marker_set_metadata) as n_marker_sets_with_eigen,
              (select count(distinct population) from metadata) as n_populations,
              (select count(*) from metadata) as n_mappings,
              (select count(distinct mapping_id) from mappings) as n_partitions, true as has_size, 0 as n_unreadable_files""",
)
def _(d):
    # The size depends on compression and file layout; pytest checks it against the file system.
    out = catalog.db_stats(d.spark, database(d))
    return out.withColumn("total_size_mb", F.col("total_size_mb") > 0).withColumnRenamed("total_size_mb", "has_size")


@query(
    "agg25_empty_partitions",
    """select mapping_id, case when population = 'ct.panel' then 1 else 0 end as n_files,
              case when population = 'ct.panel' then 1 else 0 end as n_unreadable
       from metadata where population in ('ct.panel', 'cb.panel')""",
)
def _(d):
    """Of three populations one is stored, one has a damaged file for each mapping, one has none."""
    base = scratch_dir(d.spark, "database")
    DB.write_mappings(d.mappings.where(F.col("population") == "ce.panel"), base)
    damaged = d.metadata.where(F.col("population") == "ct.panel").select("population", "mapping_id")
    stage(TX.write_bytes(damaged, catalog.table_path(base, "mappings"), b"PAR1 cut off", "part-0.parquet"), "damaged")
    return catalog.empty_partitions(d.spark, base, d.metadata.select("mapping_id"))


@query(
    "snk07_write_assessment",
    """select QTL, case when Simulated then 'TRUE' else 'FALSE' end as Simulated,
              case when Detected then 'TRUE' else 'FALSE' end as Detected, coalesce(CHROM, 'NA') as CHROM,
              cast(POS as varchar) as POS, coalesce(cast(peak_id as varchar), 'NA') as peak_id,
              case when top_hit then 'TRUE' when not top_hit then 'FALSE' else 'NA' end as top_hit,
              mode, type, threshold, algorithm_id, 'NA' as interval_var_exp from c_assess""",
)
def _(d):
    path = scratch_dir(d.spark, "assessment")
    TX.write_assessment_tsv(stored_assessment(d), path)
    names = schemas.ASSESSMENT.names
    schema = ", ".join(f"`{n}` string" for n in names)
    wanted = "QTL Simulated Detected CHROM POS peak_id top_hit mode type threshold algorithm_id interval_var_exp"
    return d.spark.read.schema(schema).csv(path, sep="\t", header=False).select(*wanted.split())


@query(
    "snk09_init_database",
    "select population, count(*) as n_rows, 0 as created_again from mappings group by population",
)
def _(d):
    base = scratch_dir(d.spark, "database")
    DB.init_database(d.spark, base)
    DB.write_mappings(d.mappings, base)
    again = DB.init_database(d.spark, base)
    return catalog.read_table(d.spark, base, "mappings").groupBy("population").agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(again)).alias("created_again")
    )


@query("snk10_hash_manifest")
def _(d):
    return TX.hash_manifest(d.spark, catalog.table_path(database(d, "markers"), "markers")).select(
        "bytes", "sha256"
    )


@query(
    "srt01_canonical_files",
    f"""select mapping_id, method as sig_threshold_method, marker, significant, peak_id from a_analyzed""",
)
def _(d):
    path = scratch_dir(d.spark, "analyzed")
    rows = analyzed(d).select(
        "mapping_id", "sig_threshold_method", "CHROM", "POS", "marker", "significant", "peak_id"
    )
    rows.hint("rebalance", "mapping_id").sortWithinPartitions(
        "mapping_id", "CHROM", "POS", "marker"
    ).write.parquet(path)
    return d.spark.read.parquet(path).drop("CHROM", "POS")
