"""Domain tables are made from stored ones."""

from __future__ import annotations

import random
import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from locuspark.sources import catalog
from locuspark.suite import files
from locuspark.suite.catalog_of_queries import QUERIES
from locuspark.suite.domain import Domain

SF = "/root/testdata/sf0.001"


def test_shared_tables_are_read_back(spark):
    """The mappings compute their statistics once and get the few mapping rows by a broadcast."""
    d = Domain(spark, SF)
    for name, scans in (("mappings", 1), ("genotypes", 0), ("causal_genotypes", 1)):
        df = d.sql(f"select * from {name}", d._stored(name))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Relation [" in line and "l_partkey" in line for line in plan.splitlines()) == scans, plan
        assert sorted(map(str, df.collect())) == sorted(map(str, d.sql(f"select * from {name}").collect()))
    physical = d.sql("select * from mappings", d._stored("mappings"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical


def test_tasks_stay_small(spark):
    """A task reads a bounded, small part of its input, so that its hash tables and sorts need not spill."""
    d = Domain(spark, SF)
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        assert int(d.spark.conf.get(key)) <= 16 << 20


# Part keys moved by this much keep their chromosome, codes and scores; their positions pass 2^31.
FAR = 6 * 7 * 11 * 13 * 1_000_003
NEEDING_POSITIONS = (
    "agg12_power_only agg31_designation_concordance pip11_compare_assessments agg09_marker_r2 src16_read_by_key "
    "snk05_write_traits snk10_hash_manifest pip05_designate pip10_legacy_assessment pip09_legacy_intervals_guarded"
).split()


def small_tables(folder, shift):
    rng = random.Random(7)
    line = [
        (
            order, rng.randrange(60), rng.randrange(12), 1, rng.choice([1.0, 7.0, 13.0, 50.0]),
            rng.randrange(100, 90000) / 1.0, rng.choice([0.0, 0.1]), rng.choice([0.0, 0.03, 0.08]), rng.choice("AR"),
        )
        for order in range(1500)
    ]
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag".split()
    lineitem = dict(zip(names, map(list, zip(*line)))) | {"l_linestatus": ["O"] * len(line)}
    lineitem["l_partkey"] = [k + shift for k in lineitem["l_partkey"]]
    part = {"p_partkey": [k + shift for k in range(60)], "p_size": [k % 50 for k in range(60)], "p_type": ["LARGE", "SMALL"] * 30}
    supplier = {"s_suppkey": list(range(12)), "s_nationkey": list(range(12)), "s_acctbal": [1.0] * 12}
    tables = {"lineitem": lineitem, "part": part, "supplier": supplier, "nation": {"n_nationkey": list(range(25))}}
    folder.mkdir()
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    return str(folder)


def moved_back(value):
    if isinstance(value, int) and value > 1000 * FAR:
        return value - 1000 * FAR
    if isinstance(value, str) and re.fullmatch(r"\d:\d+", value):
        chrom, pos = value.split(":")
        return f"{chrom}:{moved_back(int(pos))}"
    return value


def test_positions_beyond_an_int(spark, tmp_path):
    """All positions moved on by the same, beyond 2^31: the same results, moved as much."""
    near, far = small_tables(tmp_path / "near", 0), small_tables(tmp_path / "far", FAR)
    for name in NEEDING_POSITIONS:
        was, now = QUERIES[name](spark, near).collect(), QUERIES[name](spark, far).collect()
        if name == "snk10_hash_manifest":  # the bytes of the files hold the positions
            assert len(now) == len(was) > 0
            continue
        want = Counter(str(tuple(r)) for r in was)
        assert want and Counter(str(tuple(map(moved_back, r))) for r in now) == want, name


def test_marker_correlations_shuffle_genotypes_not_their_traits(spark, tmp_path):
    """One shuffle, of the markers; the rows of their traits, several times as many, stay where they are."""
    plan = QUERIES["agg09_marker_r2"](spark, small_tables(tmp_path / "t", 0))._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"hashpartitioning\((.*?)\)", plan)
    assert len(shuffles) == 1 and "marker_set_id" in shuffles[0] and "trait_id" not in shuffles[0], plan


def test_stored_tables_are_written_when_a_query_needs_them(spark, tmp_path):
    """A query of one stored table does not write the others; what is there is written once."""
    d = Domain(spark, small_tables(tmp_path / "t", 0))
    QUERIES["snk10_hash_manifest"](spark, d.sf_dir).collect()
    base = files.database(d, "markers")
    at = Path(catalog.table_path(base, "markers"))
    first = sorted(at.rglob("*.parquet"))
    assert first and not Path(catalog.table_path(base, "mappings")).exists() and not Path(catalog.table_path(base, "genotypes")).exists()
    assert files.database(d) == base and sorted(at.rglob("*.parquet")) == first
    for table in ("genotypes", "traits", "phenotypes", "causal_variants", "causal_genotypes", "mappings", "metadata"):
        assert catalog.read_table(spark, base, table).count() == d.table(table).count() > 0, table
