"""Readers and writers on small files."""

from __future__ import annotations

import gzip
import hashlib
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locuspark import schemas
from locuspark.sinks import database as DB
from locuspark.sinks import plink as plink_sink
from locuspark.sinks import text as TX
from locuspark.sources import bgzf, catalog, genotypes, params, plink, results
from locuspark.sources.footers import footers


def put(folder, name, text):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_association_results(spark, tmp_path):
    fast = put(
        tmp_path,
        "a.fastGWA",
        "CHR\tSNP\tPOS\tA1\tA2\tN\tAF1\tBETA\tSE\tP\n1\t1:13117\t13117\tA\tC\t192\t0.09\t0.63\t1.19\t0.59\n"
        "1  1:15024 15024 A G 192 0.1 nan NA 0\n",
    )
    loco = put(
        tmp_path,
        "b.mlma",
        "Chr\tSNP\tbp\tA1\tA2\tFreq\tb\tse\tp\n2\t2:7\t7\tA\tC\t0.2\t1.1\t1.2\t0.37\n",
    )
    got = rows(results.read_gwa(spark, [fast, loco]).orderBy("CHROM", "POS"))
    assert got[0] == ("1:13117", "1", 13117, "A", "C", 0.09, 0.63, 1.19, 0.59, "a.fastGWA")
    assert got[1][5:9] == (0.1, None, None, 0.0)
    assert got[2][:3] == ("2:7", "2", 7)
    with pytest.raises(ValueError, match="unknown association result format"):
        results.read_gwa(spark, str(tmp_path / "c.txt"))


def test_plink_text_files(spark, tmp_path):
    bim = put(tmp_path, "x.bim", "1\trs5\t0\t100\tA\tG\nX\t.\t0\t7\tC\tT\n")
    assert rows(plink.read_bim(spark, bim).orderBy("POS")) == [
        ("X:7", "X", 7, "C", "T"),
        ("1:100", "1", 100, "A", "G"),
    ]
    fam = put(tmp_path, "x.fam", "s1 i1 0 0 0 -9\n s2  i2\t0 0 0 1.5\n")
    assert rows(plink.read_fam(spark, fam).select("fid", "iid", "pheno")) == [
        ("s1", "i1", -9.0),
        ("s2", "i2", 1.5),
    ]
    phen = put(tmp_path, "x.phen", "AB1 AB1 1.43652\nBRC20067 X 1.6\n")
    assert rows(plink.read_phen(spark, phen)) == [("AB1", 1.43652), ("BRC20067", 1.6)]
    par = put(tmp_path, "x.par", "QTL\tRefAllele\tFrequency\tEffect\n2:7459092\tA\t0.05\t-4.5\n")
    assert rows(plink.read_par(spark, par)) == [("2:7459092", "2", 7459092, "A", 0.05, -4.5)]


def test_binary_genotypes(spark, tmp_path):
    """Every two-bit code, a sample count that does not fill a byte, several byte ranges."""
    rng = np.random.default_rng(3)
    n_samples, n_variants = 13, 37
    codes = rng.integers(0, 4, size=(n_variants, n_samples))
    width = (n_samples + 3) // 4
    packed = bytearray(b"\x6c\x1b\x01")
    for line in codes:
        data = [0] * width
        for i, c in enumerate(line):
            data[i // 4] |= int(c) << (2 * (i % 4))
        packed += bytes(data)
    put(tmp_path, "p.bed", bytes(packed))
    put(tmp_path, "p.bim", "".join(f"1\tm{i}\t0\t{i + 1}\tA\tG\n" for i in range(n_variants)))
    put(tmp_path, "p.fam", "".join(f"f{i} s{i} 0 0 0 -9\n" for i in range(n_samples)))
    prefix = str(tmp_path / "p")
    value = {0: -1.0, 1: None, 2: None, 3: 1.0}
    want = {
        ("1", v + 1, f"s{s}"): value[int(codes[v, s])]
        for v in range(n_variants)
        for s in range(n_samples)
    }
    got = {(r.CHROM, r.POS, r.strain): r.allele for r in plink.read_bed(spark, prefix, chunk=5).collect()}
    assert got == want
    some = spark.createDataFrame([("1", 4), ("1", 30)], "CHROM string, POS int")
    part = plink.read_bed(spark, prefix, some, chunk=5)
    assert part.count() == 2 * n_samples
    put(tmp_path, "bad.bed", b"\x00\x00\x00" + bytes(40))
    for ext in ("bim", "fam"):
        os.link(f"{prefix}.{ext}", tmp_path / f"bad.{ext}")
    with pytest.raises(Exception, match="not a variant-major"):
        plink.read_bed(spark, str(tmp_path / "bad")).collect()


def test_every_line_is_accounted_for(spark, tmp_path):
    folder = tmp_path / "a.mlma"
    folder.mkdir()
    put(folder, "one", "Chr SNP bp A1 A2 Freq b se p\n1 1:5 5 A C 0.1 1 NA 0.5\n\n1 1:6 six A C 0.1 1 1 0.5\n1 1:7 7\n")
    put(folder, "two", "2 2:9 9 A C 0.1 1 1 0.5 more\n2 2:10 10 A C 0.1 1 x1 0.5\n")
    lines = results.gwa_lines(spark, str(folder))
    assert sorted(rows(lines.account())) == [("one", 5, 1, 1, 1, 2), ("two", 2, 0, 0, 1, 1)]
    assert sorted(rows(lines.rejects())) == [
        ("one", 4, "1 1:6 six A C 0.1 1 1 0.5", "POS is not a whole number: six"),
        ("one", 5, "1 1:7 7", "3 fields instead of 9"),
        ("two", 2, "2 2:10 10 A C 0.1 1 x1 0.5", "SE is not a number: x1"),
    ]
    assert sorted(r.marker for r in results.read_gwa(spark, str(folder), bad="skip").collect()) == ["1:5", "2:9"]
    with pytest.raises(Exception, match="(one: POS is not a whole|one: 3 fields|two: SE is not a number)"):
        results.read_gwa(spark, str(folder)).collect()
    with pytest.raises(Exception, match="2 fields instead of 3"):
        plink.read_phen(spark, put(tmp_path, "y.phen", "A A 1\nB 2\n")).collect()
    with pytest.raises(ValueError, match="fail or skip"):
        plink.read_phen(spark, str(tmp_path / "y.phen"), bad="ignore")


def test_line_numbers_over_many_splits(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for k in range(3):
            put(tmp_path, f"part-{k}.phen", "".join(f"{k} s{i} {i}\n" for i in range(1, 900 * k + 2)))
        found = plink.phen_lines(spark, str(tmp_path)).numbered("row")
        assert found.rdd.getNumPartitions() > 3
        got = [(r.fid, r.line, int(r.value)) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 1 + 901 + 1801 and all(line == value for _, line, value in got)


def test_filesets_written_and_read(spark, tmp_path):
    rng = np.random.default_rng(8)
    names = [f"s{i}" for i in range(6)]
    want = {(c, p, s): rng.choice([-1.0, 1.0, None]) for c in ("1", "X") for p in rng.permutation(40)[:21].tolist() for s in names}
    frame = spark.createDataFrame([(*k, v) for k, v in want.items()], "CHROM string, POS int, strain string, allele double")
    written = plink_sink.write_bed(frame.where("not (CHROM = 'X' and strain = 's2')"), names, str(tmp_path / "sets"))
    assert sorted(r.n_variants for r in written.collect()) == [21, 21]
    assert sorted(os.listdir(tmp_path / "sets")) == [f"{c}.{e}" for c in ("1", "X") for e in ("bed", "bim", "fam")]
    want = {k: None if k[0] == "X" and k[2] == "s2" else v for k, v in want.items()}
    read = plink.read_bed(spark, str(tmp_path / "sets"), chunk=4)
    assert {(r.CHROM, r.POS, r.strain): r.allele for r in read.collect()} == want and read.count() == len(want)
    one = {(r.CHROM, r.POS, r.strain): r.allele for r in plink.read_bed(spark, str(tmp_path / "sets" / "X")).collect()}
    assert one == {k: v for k, v in want.items() if k[0] == "X"}
    os.remove(tmp_path / "sets" / "X.fam")
    with pytest.raises(Exception, match="no sample list"):
        plink.read_bed(spark, str(tmp_path / "sets")).collect()
    put(tmp_path / "sets", "X.fam", "s0 s0 0 0 0 -9\ns1 s1 0\n")
    with pytest.raises(Exception, match="3 fields instead of 6"):
        plink.read_bed(spark, str(tmp_path / "sets")).collect()


def test_a_fileset_is_written_in_batches(spark, tmp_path):
    """No task gathers a fileset: batches of a few variants, several filesets in a task, shuffled and absent calls."""
    calls = [(g, "1", 1000 - p, f"s{s}", [-1.0, 1.0, None][(p + s + len(g)) % 3]) for g in ("a", "bb") for p in range(50) for s in (4, 0, 2)]
    frame = spark.createDataFrame(calls, "g string, CHROM string, POS int, strain string, allele double").repartition(3)
    names = [f"s{i}" for i in range(5)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        written = plink_sink.write_bed(frame, names, str(tmp_path / "sets"), ("g", "CHROM"))
        assert "FlatMapGroups" not in written._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.n_variants for r in written.collect()) == [50, 50]
        read = {(r.POS, r.strain): r.allele for r in plink.read_bed(spark, str(tmp_path / "sets" / "bb-1"), chunk=8).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert read == {(p, s): None for p in range(951, 1001) for s in names} | {(p, s): a for g, _, p, s, a in calls if g == "bb"}
    with pytest.raises(Exception, match="not a sample: s4"):
        plink_sink.write_bed(frame, names[:4], str(tmp_path / "few"), ("g", "CHROM")).collect()


def test_genotype_files(spark, tmp_path):
    trait = "0123456789abcdef0123"
    put(
        tmp_path,
        f"{trait}_causal_geno.tsv",
        "QTL\tstrain\tallele\nI:100\tA\t-1\nI:100\tB\t1\nI:100\tC\tNA\n",
    )
    got = rows(genotypes.read_causal_genotypes_tsv(spark, str(tmp_path)))
    assert got == [
        (trait, "I:100", "I", 100, "A", -1.0),
        (trait, "I:100", "I", 100, "B", 1.0),
        (trait, "I:100", "I", 100, "C", None),
    ]
    wide = put(tmp_path, "m.tsv", "CHROM\tPOS\tREF\tALT\tX.1\tJU\n3\t7966\tG\tA\t-1\tNA\n")
    assert sorted(rows(genotypes.read_genotype_matrix_tsv(spark, wide))) == [
        ("3", 7966, "JU", None),
        ("3", 7966, "X.1", -1.0),
    ]


def test_variant_file(spark, tmp_path):
    text = (
        "##fileformat=VCFv4.2\n##contig=<ID=II,length=5>\n##contig=<ID=I>\n"
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
        "II\t5\t.\tA\tG\t.\tPASS\t.\tGT:DP\t0/0:3\t1|1:4\n"
    )
    path = str(tmp_path / "x.vcf.gz")
    with gzip.open(path, "wt") as f:
        f.write(text)
    assert not bgzf.is_block_gzip(spark, path)
    got = rows(genotypes.read_vcf(spark, path, partitions=2))
    assert sorted(got) == [("II", 5, ".", "A", "G", "s1", "0/0"), ("II", 5, ".", "A", "G", "s2", "1|1")]
    assert sorted(rows(genotypes.read_contigs(spark, path))) == [(1, "II"), (2, "I")]


def test_block_gzip_is_split_and_equals_plain_text(spark, tmp_path):
    """Ranges of every size: lines across blocks and ranges, empty lines, a block's first bytes inside data, no last line end."""
    rng = np.random.default_rng(5)
    texts = ["x" * int(n) for n in rng.integers(0, 90, 400)] + ["", "\u00e9" * 3000, "last"]
    frame = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    folder = tmp_path / "a"
    (path,) = [r.path for r in TX.write_block_gzip(frame, str(folder), ["# head"], most=700).collect()]
    path = path.removeprefix("file://")
    assert gzip.open(path, "rt").read().split("\n") == ["# head", *texts, ""] and bgzf.is_block_gzip(spark, str(folder))
    raw = open(path, "rb").read()
    for size in (60, 200, 777, 5000, 10**6):
        found = bgzf.read_block_gzip(spark, str(folder), size)
        got = [(r.start, r.value) for r in found.collect()]
        assert sorted(v for _, v in got) == sorted(["# head", *texts])
        assert len({s for s, _ in got}) > 1 or size >= len(raw)
    open_end = raw[:-28] + TX._block(bgzf.GZIP_EXTRA + b"no end of line")
    source = pa.BufferReader(open_end)
    whole = gzip.decompress(open_end).split(b"\n")
    for size in (50, 333, 4000):
        parts = [list(bgzf.lines_between(_At(source), a, min(a + size, len(open_end)), len(open_end))) for a in range(0, len(open_end), size)]
        assert [line for part in parts for line in part] == whole
    with pytest.raises(ValueError, match="no whole block"):
        list(bgzf.blocks(_At(pa.BufferReader(raw[:-40])), 0, len(raw) - 40))


class _At:
    """Positioned reads on a buffer."""

    def __init__(self, source):
        self.source = source

    def read_at(self, n, at):
        self.source.seek(at)
        return self.source.read(n)


def test_variant_files_have_to_agree(spark, tmp_path):
    head = "##contig=<ID=I>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    row = "I\t5\t.\tA\tG\t.\tPASS\t.\tGT\t0/0\t1|1\n"
    good, odd, short = (tmp_path / n for n in ("good", "odd", "short"))
    for folder in (good, odd, short):
        folder.mkdir()
        put(folder, "a.vcf", head + "s1\ts2\n" + row)
    put(good, "b.vcf", head + "s1\ts2\n" + row.replace("\t5\t", "\t6\t"))
    put(odd, "b.vcf", head + "s2\ts1\n" + row)
    put(short, "b.vcf", head + "s1\ts2\n" + row.replace("\t1|1", ""))
    assert genotypes.read_vcf(spark, str(good)).count() == 4
    with pytest.raises(ValueError, match="different samples"):
        genotypes.read_vcf(spark, str(odd))
    with pytest.raises(Exception, match="10 fields instead of 11 at I:5"):
        genotypes.read_vcf(spark, str(short)).collect()


def test_test_count_files(spark, tmp_path):
    good = tmp_path / "good"
    good.mkdir()
    put(good, "ce.test_0.05_total_independent_tests.txt", "484.839\n")
    assert rows(params.read_eigen(spark, str(good)).select("n_tests")) == [(484.839,)]
    put(good, "odd_total_independent_tests.txt", "3\n")
    put(good, "cb_0.1_total_independent_tests.txt", "many\n")
    put(good, "readme.txt", "ignored")
    got = {r.source_file.split("_total")[0]: r for r in params.build_eigen_lookup(spark, str(good)).collect()}
    assert (got["ce.test_0.05"].population, got["ce.test_0.05"].maf, got["ce.test_0.05"].problem) == ("ce.test", 0.05, None)
    assert got["odd"].problem == "unparseable name"
    assert got["cb_0.1"].problem == "not a number"
    assert len(got) == 3
    with pytest.raises(Exception, match="not a number"):
        params.read_eigen(spark, str(good / "cb_0.1_total_independent_tests.txt")).collect()


def test_mapping_columns(spark, tmp_path):
    path = put(tmp_path, "m.tsv", "CHROM\tmarker\tP\nI\tI:5\t0.1\n")
    with pytest.raises(ValueError, match="POS"):
        results.read_mapping_tsv(spark, path)


def test_strainfile_with_windows_line_ends(spark, tmp_path):
    path = put(
        tmp_path,
        "s.txt",
        "group \tspecies\tvcf\tms_maf\tms_ld\tstrains\r\n ce.test \tC_Elegans\t20220216\t0.05 \t0.8\tA, B,C \r\n",
    )
    row = params.read_strainfile(spark, path).first()
    assert (row["group"], row["species"], row["ms_maf"], row["ms_ld"]) == ("ce.test", "c_elegans", 0.05, 0.8)
    assert row["strain_list"] == ["A", "B", "C"]
    old = put(tmp_path, "old.txt", "population\tmaf\nx\t0.1\n")
    assert params.read_strainfile(spark, old).first().asDict() == {"group": "x", "ms_maf": 0.1}
    bad = put(tmp_path, "bad.txt", "name\tmaf\nx\t0.1\n")
    with pytest.raises(ValueError, match="group"):
        params.read_strainfile(spark, bad)


MANIFEST = "session\ttask_hash\tattempt\tmax_retries\tspecies\tgroup\tmaf\tnqtl\teffect\th2\trep\tmode\ttype\texit\n"


def test_replay_manifest(spark, tmp_path):
    line = "0-1\tabcd\t2\t3\tc_elegans\tce.test\t0.05\t5\tgamma\t0.3\t1\tinbred\tpca\t1\n"
    df = params.read_replay_manifest(spark, put(tmp_path, "good.tsv", MANIFEST + line))
    row = df.first()
    assert row["nqtl"] == "5" and row["h2"] == 0.3 and row["rep"] == 1 and row["exit"] == 1
    cut = MANIFEST.split("\t", 1)[1]
    with pytest.raises(ValueError, match="session"):
        params.read_replay_manifest(spark, put(tmp_path, "bad.tsv", cut + line.split("\t", 1)[1]))


def test_failure_records(spark, tmp_path):
    put(tmp_path, "a.json", '{"session": "s1", "rep": 1,\n "exit": 137}')
    put(tmp_path, "b.json", '{"session": "s1", "extra": "x", "exit": 1}')
    put(tmp_path, "c.json", '{"session": "s0", "exit": 2}')
    put(tmp_path, "d.json", '{"session": "s1", "exit"')
    put(tmp_path, "notes.txt", "not a record")
    got = params.read_failures(spark, str(tmp_path), "s1")
    assert sorted(r["exit"] for r in got.collect()) == [1, 137]
    assert {"rep", "extra"} <= set(got.columns)


def test_value_lists(spark, tmp_path):
    path = put(tmp_path, "h2.txt", "0.2\n\n 0.4 \n")
    assert [r[0] for r in params.read_values(spark, path).collect()] == ["0.2", "0.4"]


def small_mappings(spark, beta=0.5, ids=("m1", "m2")):
    return spark.createDataFrame(
        [("p", m, f"1:{i}", 0.1, beta, 0.2, 0.3) for m in ids for i in range(4)],
        "population string, mapping_id string, marker string, AF1 double, BETA double, SE double, P double",
    )


def test_rewriting_one_mapping_leaves_the_others(spark, tmp_path):
    base = str(tmp_path / "db")
    DB.write_mappings(small_mappings(spark), base)
    DB.write_mappings(small_mappings(spark, 0.9, ("m2",)), base)
    got = catalog.read_table(spark, base, "mappings")
    assert {(r.mapping_id, r.BETA) for r in got.collect()} == {("m1", 0.5), ("m2", 0.9)}
    assert got.count() == 8


def test_only_the_wanted_partition_is_read(spark, tmp_path):
    base = str(tmp_path / "db")
    DB.write_mappings(small_mappings(spark), base)
    one = catalog.read_table(spark, base, "mappings").where("population = 'p' and mapping_id = 'm1'")
    plan = one.select("marker")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(population" in plan and "ReadSchema: struct<marker:string>" in plan
    assert one.select(F.input_file_name()).distinct().count() == len(
        [f for f in one.inputFiles() if "mapping_id=m1" in f]
    )


def test_digit_ids_stay_text(spark, tmp_path):
    base = str(tmp_path / "db")
    DB.write_mappings(small_mappings(spark, ids=("00000000000000000012",)), base)
    assert catalog.read_table(spark, base, "mappings").first()["mapping_id"] == "00000000000000000012"


def test_database_life_cycle(spark, tmp_path):
    base = str(tmp_path / "db")
    with pytest.raises(FileNotFoundError):
        catalog.open_db(spark, base)
    made = DB.init_database(spark, base)
    assert set(made) == set(catalog.LAYOUT)
    assert DB.init_database(spark, base) == []
    DB.write_mappings(small_mappings(spark), base)
    assert set(catalog.open_db(spark, base)) == set(catalog.VIEWS)
    assert spark.table("mappings").count() == 8
    assert catalog.read_by_key(spark, base, "traits", "trait_id", "x", required=False) is None
    with pytest.raises(LookupError):
        catalog.read_by_key(spark, base, "traits", "trait_id", "x")
    assert not DB.write_regions(spark.createDataFrame([], schemas.QTL_REGIONS), base)
    stats = catalog.db_stats(spark, base).first()
    size = sum(
        os.path.getsize(os.path.join(d, f))
        for table in ("markers", "mappings", "metadata", "marker_set_metadata")
        for d, _s, fs in os.walk(catalog.table_path(base, table))
        for f in fs
        if f.endswith(".parquet")
    )
    assert stats["n_partitions"] == 2 and stats["n_unreadable_files"] == 0 and stats["total_size_mb"] == round(size / 1024**2, 2)


def test_unreadable_partition_counts_as_empty(spark, tmp_path):
    base = str(tmp_path / "db")
    DB.write_mappings(small_mappings(spark), base)
    for d, _s, fs in os.walk(catalog.table_path(base, "mappings")):
        for f in fs:
            if "mapping_id=m2" in d and f.endswith(".parquet"):
                (open(os.path.join(d, f), "wb")).write(b"broken")
                os.remove(os.path.join(d, f".{f}.crc"))
    expected = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "mapping_id string")
    got = catalog.empty_mappings(expected, catalog.read_tolerant(spark, base))
    assert sorted(r[0] for r in got.collect()) == ["m2", "m3"]
    (broken,) = footers(spark, catalog.table_path(base, "mappings")).where("problem is not null").collect()
    assert "mapping_id=m2" in broken.path and broken.bytes == 6 and broken.n_rows is None
    found = catalog.empty_partitions(spark, base, expected)
    assert sorted(map(tuple, found.collect())) == [("m2", 1, 1), ("m3", 0, 0)]
    assert footers(spark, str(tmp_path / "none")).count() == 0


def test_file_hashes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    put(tmp_path, "a.bin", b"abc" * 1000)
    put(tmp_path / "sub", "b.bin", b"")
    got = {os.path.basename(r.path): (r.bytes, r.sha256) for r in TX.hash_manifest(spark, str(tmp_path), block=7).collect()}
    assert got == {
        "a.bin": (3000, hashlib.sha256(b"abc" * 1000).hexdigest()),
        "b.bin": (0, hashlib.sha256(b"").hexdigest()),
    }


def test_assessment_text(spark, tmp_path):
    df = spark.createDataFrame([("1:5", True, None)], "QTL string, Simulated boolean, Detected boolean")
    path = str(tmp_path / "out")
    TX.write_assessment_tsv(df, path)
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert len(lines) == 1
    cells = lines[0].split("\t")
    assert len(cells) == 35 and cells[:3] == ["1:5", "TRUE", "NA"]


def test_lines_are_split_once(spark, tmp_path):
    """A filter on the kind of a line reads its words, it does not split the line for every field again."""
    path = put(tmp_path, "a.fastGWA", "1 1:5 5 A C 9 0.1 nan NA 1e-9\n \n1 1:6 x A C 9 0.1 0 0 0\n1 1:7\n")
    lines = results.gwa_lines(spark, path)
    for table in (lines.rows("skip"), lines.rejects(), lines.account()):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace(") == plan.count("Relation ["), plan
    assert [r.SNP for r in lines.rows("skip").collect()] == ["1:5"]
    assert sorted((r.line, r.problem) for r in lines.rejects().collect()) == [
        (3, "POS is not a whole number: x"),
        (4, "2 fields instead of 10"),
    ]
    assert rows(lines.account()) == [("a.fastGWA", 4, 0, 1, 1, 2)]


def test_many_small_files_share_folders(spark, tmp_path):
    """A file per row, in as many folders as there are shuffle partitions and by as many tasks."""
    table = spark.range(300).select(F.concat(F.lit("p"), "id", F.lit("_0.05_total_independent_tests.txt")).alias("name"), F.concat("id", F.lit("\nrest")).alias("value"))
    folder = str(tmp_path / "eigen")
    paths = TX.write_files(table, folder).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.path for r in paths}) == 300
    folders = {r.path.rsplit("/", 2)[1] for r in paths}
    assert len(folders) == len(os.listdir(folder)) == 4
    assert len({r.task for r in paths}) > 1
    got = params.build_eigen_lookup(spark, folder).select("population", "n_tests", "problem").collect()
    assert sorted((int(r.population[1:]), r.n_tests, r.problem) for r in got) == [(i, float(i), None) for i in range(300)]


def test_positions_beyond_an_int_are_read(spark, tmp_path):
    far = 7_200_000_000
    bim = put(tmp_path, "x.bim", f"1\trs5\t0\t{far}\tA\tG\n")
    assert rows(plink.read_bim(spark, bim)) == [(f"1:{far}", "1", far, "A", "G")]
    par = put(tmp_path, "x.par", f"QTL RefAllele Frequency Effect\n2:{far} A 0.1 0.5\n")
    assert rows(plink.read_par(spark, par).select("CHROM", "POS")) == [("2", far)]
    gwa = put(tmp_path, "x.mlma", f"Chr SNP bp A1 A2 Freq b se p\n2 2:{far} {far} A C 0.2 1.1 1.2 0.37\n")
    assert rows(results.read_gwa(spark, gwa).select("marker", "POS")) == [(f"2:{far}", far)]
    matrix = put(tmp_path, "m.tsv", f"CHROM\tPOS\tREF\tALT\tS0\n1\t{far}\tA\tG\t-1\n")
    assert rows(genotypes.read_genotype_matrix_tsv(spark, matrix)) == [("1", far, "S0", -1.0)]
    variants = put(tmp_path, "v.vcf", f"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS0\n1\t{far}\t.\tA\tG\t.\t.\t.\tGT\t0/0\n")
    assert rows(genotypes.read_vcf(spark, variants).select("POS", "gt")) == [(far, "0/0")]
    packed = spark.createDataFrame([("1", far, bytearray([0b11]))], "CHROM string, POS long, bytes binary")
    assert rows(plink.decode_packed(packed, ["S0"])) == [("1", far, "S0", 1.0)]
    typed = spark.createDataFrame([("1", far, "S0", 1.0), ("1", far + 5, "S0", None)], "CHROM string, POS long, strain string, allele double")
    plink_sink.write_bed(typed, ["S0"], str(tmp_path / "sets")).collect()
    assert sorted(rows(plink.read_bed(spark, str(tmp_path / "sets"))))[0] == ("1", far, "S0", 1.0)
    assert len(rows(plink.read_bed(spark, str(tmp_path / "sets")))) == 2


def test_tables_stored_with_int_positions_are_read(spark, tmp_path):
    base = str(tmp_path)
    old = spark.createDataFrame([("m1", "1", 100, "S0", 1.0)], "marker_set_id string, CHROM string, POS int, strain string, allele double")
    old.write.partitionBy("marker_set_id").parquet(catalog.table_path(base, "genotypes"))
    new = spark.createDataFrame([("m2", "1", 7_200_000_000, "S0", 1.0)], "marker_set_id string, CHROM string, POS long, strain string, allele double")
    DB.write_genotypes(new, base)
    got = catalog.read_table(spark, base, "genotypes").select("marker_set_id", "POS")
    assert sorted(rows(got)) == [("m1", 100), ("m2", 7_200_000_000)]
