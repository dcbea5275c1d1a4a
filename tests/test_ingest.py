"""Nothing is lost or doubled on the way into the database."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from locuspark.sinks.database import write_mappings
from locuspark.sinks.versions import Versioned
from locuspark.sources.catalog import read_table
from locuspark.sources.plink import read_bed
from locuspark.streaming.jobs import read_ingested, stream_ingest

SCHEMA = "population string, mapping_id string, marker string, AF1 double, BETA double, SE double, P double"


def rows(spark, markers, beta=1.0, mapping="m"):
    return spark.createDataFrame([("p", mapping, f"1:{k}", 0.1, beta, 0.1, 0.5) for k in markers], SCHEMA)


def stored(spark, base):
    return sorted((r.mapping_id, r.marker, r.BETA) for r in read_table(spark, base, "mappings").collect())


def test_writer_stores_a_marker_once(spark, tmp_path):
    base = str(tmp_path / "db")
    write_mappings(rows(spark, [1, 2, 2, 3]).unionByName(rows(spark, [3], 2.0)), base, order=[-F.col("BETA")])
    assert stored(spark, base) == [("m", "1:1", 1.0), ("m", "1:2", 1.0), ("m", "1:3", 2.0)]


def ingested(spark, base):
    return sorted((r.mapping_id, r.marker, r.BETA) for r in read_ingested(spark, base).collect())


def test_stream_takes_parts_and_late_files(spark, tmp_path):
    """Parts add up; a file older than what is stored changes nothing, in the same batch or a later one."""
    arriving, base, checkpoint = (str(tmp_path / x) for x in ("in", "db", "check"))

    def deliver(frame, time=None):
        before = set(os.listdir(arriving)) if os.path.isdir(arriving) else set()
        frame.coalesce(1).write.mode("append").parquet(arriving)
        for f in set(os.listdir(arriving)) - before:
            if time and f.endswith("parquet"):
                os.utime(f"{arriving}/{f}", (time, time))

    deliver(rows(spark, range(10)))
    stream_ingest(spark, arriving, base, checkpoint).awaitTermination()
    deliver(rows(spark, range(5, 20)), 1_000_000_000)
    deliver(rows(spark, range(10, 15), 2.0))
    stream_ingest(spark, arriving, base, checkpoint).awaitTermination()
    want = {(f"1:{k}", 2.0 if 10 <= k < 15 else 1.0) for k in range(20)}
    assert {(m, b) for _, m, b in ingested(spark, base)} == want and len(ingested(spark, base)) == 20
    deliver(rows(spark, range(12, 22), 7.0), 900_000_000)
    stream_ingest(spark, arriving, base, checkpoint).awaitTermination()
    assert {(m, b) for _, m, b in ingested(spark, base)} == want | {("1:20", 7.0), ("1:21", 7.0)}


def test_stream_rerun_replaces(spark, tmp_path):
    arriving, base, checkpoint = (str(tmp_path / x) for x in ("in", "db", "check"))
    for run, markers, beta in ((1, range(5), 1.0), (1, range(5, 8), 1.5), (3, [0, 2], 2.0), (2, range(9), 9.0), (3, [4], 2.5)):
        rows(spark, markers, beta).unionByName(rows(spark, [1], beta, "other")).withColumn("run", F.lit(run)).write.mode("append").parquet(arriving)
        stream_ingest(spark, arriving, base, checkpoint).awaitTermination()
    assert ingested(spark, base) == [("m", "1:0", 2.0), ("m", "1:2", 2.0), ("m", "1:4", 2.5), ("other", "1:1", 2.5)]
    assert "run" not in read_ingested(spark, base).columns


def table_of(spark, path, **more):
    return Versioned(spark, str(path), ("population", "mapping_id"), ("marker",), **more)


def test_commits_are_applied_once(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", buckets=4)
    assert table.read() is None
    table.commit(rows(spark, []), "empty")
    assert table.read() is None
    table.commit(rows(spark, range(4)), "a", F.lit(1), F.lit(1))
    first = sorted(map(tuple, table.read().collect()))
    table.commit(rows(spark, range(2), 5.0), "b", F.lit(1), F.lit(2))
    second = sorted(map(tuple, table.read().collect()))
    assert first != second and len(second) == 4
    for name in ("b", "a", "b"):  # replays, whatever they bring
        table.commit(rows(spark, range(9), 8.0), name, F.lit(1), F.lit(9))
        assert sorted(map(tuple, table.read().collect())) == second
    # A commit that ended before its snapshot showed is invisible, and done again under the same number.
    os.remove(tmp_path / "t" / "snapshots" / table.snapshots()[-1] / "_visible")
    assert sorted(map(tuple, table.read().collect())) == first
    table.commit(rows(spark, range(2), 5.0), "b", F.lit(1), F.lit(2))
    assert sorted(map(tuple, table.read().collect())) == second and len(table.snapshots()) == 3
    table.commit(rows(spark, []), "nothing")
    assert sorted(map(tuple, table.read().collect())) == second


def test_compaction_keeps_rows_and_bounds_folders(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", buckets=2)
    want = {}
    for k in range(11):
        frame = rows(spark, range(k, k + 3), float(k)).unionByName(rows(spark, [k], float(k), f"m{k % 3}"))
        table.commit(frame, f"c{k}", F.lit(0), F.lit(k), compact_after=4)
        want |= {("m", f"1:{j}"): float(k) for j in range(k, k + 3)} | {(f"m{k % 3}", f"1:{k}"): float(k)}
        assert {(r.mapping_id, r.marker): r.BETA for r in table.read().collect()} == want
        assert len(os.listdir(tmp_path / "t" / "data")) <= 6 and len(os.listdir(tmp_path / "t" / "snapshots")) <= 6
    # What was compacted away still counts as applied.
    table.commit(rows(spark, range(3), 0.0), "c0", F.lit(0), F.lit(0))
    assert {(r.mapping_id, r.marker): r.BETA for r in table.read().collect()} == want


def test_look_up_reads_one_file(spark, tmp_path):
    """Files do not multiply with ids, and a look-up touches the one that holds its id."""
    table = table_of(spark, tmp_path / "t", buckets=4)
    many = rows(spark, [])
    for k in range(30):
        many = many.unionByName(rows(spark, range(3), float(k), f"id{k}"))
    table.commit(many.coalesce(2), "a")
    files = [f for _, _, names in os.walk(tmp_path / "t" / "data") for f in names if f.endswith(".parquet")]
    assert len(files) == 4
    found = table.look_up(population="p", mapping_id="id7")
    assert {(r.marker, r.BETA) for r in found.collect()} == {(f"1:{k}", 7.0) for k in range(3)}
    assert found.select(F.input_file_name()).distinct().count() == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scan = table.look_up(population="p", mapping_id="id7")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [" in scan and "_bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(mapping_id,id7)" in scan
    table.commit(rows(spark, [1], 70.0, "id7"), "b", F.lit(0), F.lit(1))
    assert {(r.marker, r.BETA) for r in table.look_up(population="p", mapping_id="id7").collect()} == {("1:0", 7.0), ("1:1", 70.0), ("1:2", 7.0)}
    with pytest.raises(LookupError):
        table.look_up(population="p", mapping_id="none")


def test_truncated_binary_genotypes_are_an_error(spark, tmp_path):
    (tmp_path / "x.fam").write_text("".join(f"s{k} s{k} 0 0 0 -9\n" for k in range(5)))
    (tmp_path / "x.bim").write_text("".join(f"1\t1:{k}\t0\t{k}\tA\tG\n" for k in range(1, 5)))
    (tmp_path / "x.bed").write_bytes(b"\x6c\x1b\x01" + bytes(8))
    assert read_bed(spark, str(tmp_path / "x")).count() == 20
    (tmp_path / "x.bed").write_bytes(b"\x6c\x1b\x01" + bytes(6))
    with pytest.raises(Exception, match="9 bytes"):
        read_bed(spark, str(tmp_path / "x")).collect()
