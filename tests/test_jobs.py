"""Grids, verification, replay, linkage, work logs, comparison and streaming."""

from __future__ import annotations

import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from locuspark.operators import compare, genotype, grid, linkage, quality, sets, workdir
from locuspark.plans import verify as V
from locuspark.session import stage
from locuspark.streaming import read_ledger, read_replication, stream_ledger, stream_replication
from locuspark.suite.catalog_of_queries import ORACLES, QUERIES

REPS = 2


def groups(spark):
    return spark.createDataFrame(
        [(p, 0.05, "c_elegans", "20220216", 0.8, f"set_{p}", True, 10, 6.0) for p in ("p1", "p2")],
        "population string, maf double, species string, vcf_release_id string, ms_ld double, marker_set_id string, "
        "marker_set_metadata_present boolean, n_markers int, n_independent_tests double",
    )


@pytest.fixture(scope="module")
def expectation(spark):
    return V.Expectation(groups(spark), (1, 5), (0.3, 0.8), ("gamma",), REPS, 0.05, 0.8)


@pytest.fixture(scope="module")
def metadata(spark, expectation):
    return V.expected_ids(expectation)


def components(meta):
    names = {"marker_set": "marker_set_id", "trait": "trait_id", "mapping": "mapping_id"}
    return {c: (meta, names[unit]) for c, unit in V.COMPONENTS.items()}


def verified(meta, e=None):
    return V.verify(meta, components(meta), meta, meta, e)


def test_complete_database(metadata, expectation):
    out = verified(metadata, expectation)
    assert out["status"].first()[0] == "complete"
    assert out["missing_mappings"].isEmpty() and out["missing_traits"].isEmpty()
    assert {r["pct_complete"] for r in out["mappings_delta"].collect()} == {1.0}
    assert metadata.count() == 64 and metadata.select("trait_id").distinct().count() == 16


def test_dropped_rows_are_named(metadata, expectation):
    part = metadata.where("not (population = 'p2' and rep = 2 and algorithm = 'loco')")
    out = verified(part, expectation)
    assert out["status"].first()[0] == "incomplete"
    assert out["missing_mappings"].count() == 8
    assert out["missing_traits"].isEmpty()
    gaps = out["mappings_delta"].where("missing > 0").collect()
    assert len(gaps) == 8 and {(g["expected"], g["observed"]) for g in gaps} == {(2, 1)}
    top = grid.top_gaps(out["mappings_delta"], 3).collect()
    assert [r["nqtl"] for r in top] == [1, 1, 1]


def test_discovery(metadata):
    out = verified(metadata)
    assert out["status"].first()[0] == "discovery"
    row = out["observed_grid"].first()
    assert (row["nqtl"], row["h2"], row["reps_max"]) == ("1,5", "0.3,0.8", 2)


def test_status_rules(spark):
    none = spark.createDataFrame([("x", 1, 0)], "component string, missing long, observed long")
    assert V.status_of(none, 0, True, True, 1).first()[0] == "error"
    assert V.status_of(none.where("false"), 1, True, False).first()[0] == "incomplete"
    assert V.status_of(none.where("false"), 1, True, True, 1).first()[0] == "incomplete"
    assert V.status_of(none.where("false"), 1, True, True).first()[0] == "complete"


def test_replay_key_uses_text_and_single_precision(spark):
    manifest = spark.createDataFrame(
        [("c_elegans", "p1", "5", "gamma", 0.30000001192092896, 1)],
        "species string, group string, nqtl string, effect string, h2 double, rep int",
    )
    cells = spark.createDataFrame(
        [("c_elegans", "p1", n, "gamma", h, r) for n in (5, 1) for h in (0.3, 0.8) for r in (1, 2)],
        "species string, group string, nqtl int, effect string, h2 double, rep int",
    )
    kept = grid.replay_filter(cells, manifest)
    assert [tuple(r) for r in kept.collect()] == [("c_elegans", "p1", 5, "gamma", 0.3, 1)]
    assert kept.columns == cells.columns


def test_deleting_slots_twice_changes_nothing(spark, metadata):
    manifest = spark.createDataFrame(
        [("c_elegans", "p1", 0.05, "5", "gamma", 0.3, 1)],
        "species string, group string, maf double, nqtl string, effect string, h2 double, rep int",
    )
    sets_ = groups(spark)
    ids = grid.slot_ids(manifest, sets_, 0.05, 0.8)
    once = grid.delete_slots(metadata, ids, "mapping_id")
    assert metadata.count() - once.count() == 4
    assert grid.delete_slots(once, ids, "mapping_id").count() == once.count()
    unknown = grid.slot_ids(manifest, sets_.where("false"), 0.05, 0.8)
    with pytest.raises(Exception, match="missing id parameters"):
        unknown.collect()


def test_one_to_one_joins_refuse_copies(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="duplicate key"):
        grid.require_unique(df, ["k"]).collect()
    assert quality.dq_unique(df, ["k"]).first()["copies"] == 2


def genotype_frame(spark, matrix):
    rows = [
        ("s", "1", (i + 1) * 10, f"n{j:02d}", None if np.isnan(v) else float(v))
        for i, line in enumerate(matrix)
        for j, v in enumerate(line)
    ]
    return spark.createDataFrame(
        rows, "marker_set_id string, CHROM string, POS int, strain string, allele double"
    )


def random_matrix(seed, n_markers, n_strains, missing=0.0, copy=0.0):
    rng = np.random.default_rng(seed)
    out = rng.choice([-1.0, 1.0], size=(n_markers, n_strains))
    for i in range(1, n_markers):
        if rng.random() < copy:
            out[i] = out[i - 1]
            out[i, rng.integers(n_strains)] *= -1
    out[rng.random(out.shape) < missing] = np.nan
    return out


def r2_by_hand(a, b):
    both = ~np.isnan(a) & ~np.isnan(b)
    x, y = a[both], b[both]
    if len(x) == 0 or x.std() == 0 or y.std() == 0:
        return None
    return float(np.corrcoef(x, y)[0, 1] ** 2)


def test_pairwise_r2_matches_a_plain_loop(spark):
    m = random_matrix(1, 60, 12, missing=0.2)
    pairs = linkage.ld_pairs(genotype_frame(spark, m), window=7, block=9).collect()
    want = {(i, j): r2_by_hand(m[i], m[j]) for i in range(60) for j in range(i + 1, min(i + 7, 60))}
    assert {(p.i, p.j) for p in pairs} == set(want)
    assert len(pairs) == len(want)
    for p in pairs:
        assert (p.r2 is None) == (want[p.i, p.j] is None)
        if p.r2 is not None:
            assert p.r2 == pytest.approx(want[p.i, p.j], abs=1e-12)


def test_codes_of_a_marker_are_not_gathered_for_pairs(spark):
    m = random_matrix(3, 150, 9, missing=0.3)
    frame = genotype_frame(spark, m)
    pairs = linkage.ld_pairs(frame.unionByName(frame.limit(5)).repartition(5), window=20, block=100)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "FlatMapGroupsInArrow" in plan
    found = {(p.i, p.j): p.r2 for p in pairs.collect()}
    assert set(found) == {(i, j) for i in range(150) for j in range(i + 1, min(i + 20, 150))}
    for (i, j), r2 in found.items():
        want = r2_by_hand(m[i], m[j])
        assert (r2 is None) == (want is None) and (want is None or r2 == pytest.approx(want, abs=1e-12))


def prune_by_hand(m, limit, window, step, maf=None):
    """Windows one after the other over the whole chromosome."""
    if maf is None:
        af = (m == 1).mean(axis=1)
        maf = np.minimum(af, 1 - af)
    gone = set()
    start = 0
    while start < len(m):
        block = range(start, min(start + window, len(m)))
        for i in block:
            for j in block:
                seen_before = start > 0 and j < start - step + window
                if j <= i or i in gone or j in gone or seen_before:
                    continue
                r2 = r2_by_hand(m[i], m[j])
                if r2 is not None and r2 > limit:
                    gone.add(i if maf[i] < maf[j] else j)
        start += step
    return {(i + 1) * 10 for i in gone}


@pytest.mark.parametrize("seed", [2, 3])
def test_pruning_matches_a_plain_loop(spark, seed):
    m = random_matrix(seed, 80, 14, copy=0.6)
    frame = genotype_frame(spark, m)
    pairs = linkage.ld_pairs(frame, window=10, block=16)
    removed = linkage.ld_prune(pairs, genotype.allele_frequency(frame, low=None), 0.6, 10, 3)
    got = [r["POS"] for r in removed.collect()]
    assert len(got) == len(set(got)) > 0
    assert set(got) == prune_by_hand(m, 0.6, 10, 3)


def test_elimination_along_an_unbroken_run(spark):
    """A chromosome-long run of equal markers and chains, where each removal depends on the one before."""
    rng = np.random.default_rng(7)
    m = np.repeat(rng.choice([-1.0, 1.0], (6, 12)), 40, axis=0)
    m[::7, 3] *= -1
    frame = genotype_frame(spark, m)
    removed = linkage.ld_prune(linkage.ld_pairs(frame, window=10, block=16), genotype.allele_frequency(frame, low=None), 0.5, 10, 3)
    got = [r["POS"] for r in removed.collect()]
    assert len(got) == len(set(got)) and set(got) == prune_by_hand(m, 0.5, 10, 3)
    assert linkage.eliminate(linkage.ld_edges(linkage.ld_pairs(frame.limit(0)), genotype.allele_frequency(frame, low=None), 0.5)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_elimination_of_any_ordered_edges(spark, seed):
    rng = random.Random(seed)
    edges = []
    for c in ("1", "2"):
        for t in rng.sample(range(10_000), 120):
            a, b = rng.sample(range(30), 2)
            edges.append(("s", c, (t, 0, 0), a, b, a * 10))
    schema = "marker_set_id string, CHROM string, at struct<entered:long,i:long,j:long>, loser long, winner long, pos int"
    got = {(r.CHROM, r.POS) for r in linkage.eliminate(spark.createDataFrame(edges, schema)).collect()}
    gone = set()
    for _, c, _, a, b, _ in sorted(edges, key=lambda e: e[2]):
        if (c, a * 10) not in gone and (c, b * 10) not in gone:
            gone.add((c, a * 10))
    assert got == gone


def test_independent_tests_match_the_full_correlation_matrix(spark):
    m = random_matrix(5, 30, 11, copy=0.3)
    m[3, 2] = np.nan
    m[7] = 1.0
    known = m[~np.isnan(m).any(axis=1)]
    af = (known == 1).mean(axis=1)
    used = known[(af >= 0.05) & (af <= 0.95)]
    value = np.abs(np.linalg.eigvalsh(np.corrcoef(used)))
    value = np.where(np.abs(value - np.rint(value)) < 1e-9, np.rint(value), value)
    want = (value > 1).sum() + (value - np.floor(value)).sum()
    got = linkage.independent_tests(genotype_frame(spark, m).repartition(5)).collect()
    assert len(got) == 1 and got[0]["n_tests"] == pytest.approx(want, abs=1e-6)


def test_gram_in_tiles_equals_the_product(spark, monkeypatch):
    """Tiles smaller than the panel, more tasks than are added up at once."""
    monkeypatch.setattr(linkage, "TILE", 4)
    monkeypatch.setattr(linkage, "ADDED", 2)
    m = random_matrix(6, 60, 11, copy=0.2)
    m = m[~np.isnan(m).any(axis=1)]
    frame = genotype_frame(spark, m).repartition(7)
    names = sorted({r["strain"] for r in frame.select("strain").distinct().collect()})
    tiles = linkage.gram_tiles(frame)
    assert {(t.a, t.b) for t in tiles.collect()} == {(a, b) for a in range(3) for b in range(a, 3)}
    got = {(r.i, r.j): r.v for r in linkage.gram_cells(tiles).collect()}
    wide = frame.groupBy("CHROM", "POS").pivot("strain", names).agg(F.first("allele")).toPandas()[names].to_numpy(float)
    af = (wide == 1).mean(axis=1)
    wide = wide[(af >= 0.05) & (af <= 0.95)]
    z = wide - wide.mean(axis=1, keepdims=True)
    z /= np.sqrt((z * z).sum(axis=1, keepdims=True))
    want = z.T @ z
    assert set(got) == {(i, j) for i in range(11) for j in range(i, 11)}
    assert all(v == pytest.approx(want[i, j], abs=1e-9) for (i, j), v in got.items())


def test_quantiles_are_exact(spark):
    """400,000 rows in one group, heavy ties, any scale and both signs, null groups and single values."""
    rng = np.random.default_rng(4)
    n = 400_000
    big = spark.range(n).select(F.lit("big").alias("g"), F.round(F.exp(F.randn(3)), 3).alias("v"), (F.rand(5) - 0.5).alias("w"))
    scales = np.concatenate([rng.choice([-1, 1], 300) * 10.0 ** rng.uniform(-300, 300, 300), [0.0, -0.0, 5e-324, -1.7e308, 1.7e308, np.nan]])
    small = [("flat", 1.0, -2.0)] * 900 + [("scales", float(v), float(-v)) for v in scales] + [(None, 3.0, None), (None, 5.0, 7.0), ("none", None, 1.0), ("two", 1.0, 1.0), ("two", 4.0, float("nan"))]
    rows = stage(big.unionByName(spark.createDataFrame(small, "g string, v double, w double")), "quantile-rows")
    quantiles = (0.5, 0.95, 0.0, 1.0, 1 / 3)
    got = {r["g"]: r for r in workdir.exact_quantiles(rows, ["g"], {"v": quantiles, "w": (0.25,)}).collect()}
    assert set(got) == {"big", "flat", "scales", None, "none", "two"}
    local = rows.toPandas()
    for g, r in got.items():
        mine = local[local["g"].isna()] if g is None else local[local["g"] == g]
        for column, qs in (("v", quantiles), ("w", (0.25,))):
            values = mine[column].dropna().to_numpy()
            for i, q in enumerate(qs):
                assert r[f"{column}_q{i}"] == (pytest.approx(np.quantile(values, q), rel=1e-12) if len(values) else None), (g, column, q)
    assert workdir.exact_quantiles(rows.limit(0), ["g"], {"v": (0.5,)}).count() == 0


def test_panel_size_from_names(spark):
    tasks = spark.createDataFrame(
        [("w1", "P", "x.n12_a"), ("w2", "P", "x.n12.name"), ("w3", None, "none")],
        "work_dir string, process string, tag string",
    )
    files = spark.createDataFrame(
        [("w1", "f", 5.0, "a.txt"), ("w1", "l", 9.0, "z"), ("w2", "f", 1.0, "b"), ("w3", "f", 3.0, "y.n7"), ("w3", "f", 3.0, "c")],
        "work_dir string, kind string, bytes double, file_name string",
    )
    usage = spark.createDataFrame([("w1", 10.0)], "work_dir string, total_bytes double")
    got = {r.work_hash: r for r in workdir.join_workdir(tasks, usage, files).collect()}
    assert got["w1"].panel_size == "12" and got["w1"].largest_file_name == "a.txt"
    assert (got["w1"].n_files, got["w1"].n_symlinks, got["w1"].n_real_files) == (2, 1, 1)
    assert got["w2"].panel_size == "NA" and got["w2"].total_bytes == 0.0
    assert got["w3"].process == "UNKNOWN" and got["w3"].largest_file_name == "c"


def test_first_row_per_key(spark):
    rows = [("k", i, f"v{i}") for i in range(50)] + [("j", 3, "x")]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "key string, at int, v string")
    assert sorted(tuple(r) for r in sets.dedup_first(df, ["key"], ["at"]).collect()) == [
        ("j", 3, "x"),
        ("k", 0, "v0"),
    ]


def test_identical_runs_agree_fully(spark):
    cell = [("5", "1", "0.3", "0.05", "gamma", "p", "inbred_pca_BF")]
    rows = [
        (*cell[0], q, sim, det, sig, start, end)
        for q, sim, det, sig, start, end in [
            ("1:5", True, True, 1, 1, 9),
            ("1:50", True, False, 0, None, None),
            ("2:7", False, True, None, 7, 7),
        ]
    ]
    run = spark.createDataFrame(
        rows,
        "nQTL string, simREP string, h2 string, maf string, effect_distribution string, strain_set_id string, "
        "algorithm_id string, QTL string, Simulated boolean, Detected boolean, significant int, startPOS int, endPOS int",
    )
    other = run.withColumn("algorithm_id", F.lit("LMM-EXACT-INBRED_PCA_BF"))
    row = compare.compare_assessments(compare.pair_assessments(run, other)).first()
    assert (row["n_qtl"], row["n_intervals"]) == (3, 2)
    assert row["detection_concordance"] == row["designation_concordance"] == row["interval_concordance"] == 1.0


def test_roundtrip_tolerance(spark):
    raw = spark.createDataFrame([("m", "a", 1.0), ("m", "b", None), ("m", "c", 1.0)], "mapping_id string, marker string, P double")
    stored = spark.createDataFrame([("m", "a", 1.0 + 1e-14), ("m", "b", 2.0), ("m", "d", 1.0)], "mapping_id string, marker string, P double")
    got = {r["marker"]: r["problem"] for r in compare.roundtrip_diff(raw, stored, ["P"]).collect()}
    assert got == {"b": "value", "c": "only_raw", "d": "only_stored"}


EVENT = (
    "species string, grp string, nqtl string, effect string, h2 double, rep int, mode string, type string, "
    "attempt long, exit_code int"
)


def event(rep, attempt, code):
    return ("c", "g", "5", "gamma", 0.3, rep, "inbred", "pca", attempt, code)


def test_ledger_survives_restarts_and_late_records(spark, tmp_path):
    arriving, base, check = (str(tmp_path / n) for n in ("in", "ledger", "check"))
    batches = [
        [event(1, 1, 1), event(2, 1, 137), event(3, 2, 0)],
        [event(1, 2, 0), event(2, 3, 1)],
        [event(2, 2, 0), event(3, 1, 5)],
    ]
    seen = []
    for batch in batches:
        df = spark.createDataFrame(batch, EVENT)
        df.write.mode("append").parquet(arriving)
        seen.append(df)
        stream = spark.readStream.schema(df.schema).parquet(arriving)
        stream_ledger(stream, base, check).awaitTermination()
        now = {(r["rep"], r["attempt"]) for r in read_ledger(spark, base).collect()}
        key = ["species", "grp", "nqtl", "effect", "h2", "rep", "mode", "type"]
        want = sets.latest_state(sets.union_all(seen), key)
        assert now == {(r["rep"], r["attempt"]) for r in want.collect()}
    assert now == {(2, 3)}


def test_ledger_of_many_batches_equals_the_batch_operator(spark, tmp_path):
    """Every batch is a restart from the checkpoint; neither folders nor snapshots pile up."""
    arriving, base, check = (str(tmp_path / n) for n in ("in", "ledger", "check"))
    rng = random.Random(12)
    seen, folders = [], []
    key = ["species", "grp", "nqtl", "effect", "h2", "rep", "mode", "type"]
    for _ in range(13):
        df = spark.createDataFrame([event(rng.randint(1, 9), a, rng.choice([0, 1])) for a in rng.sample(range(99), 4)], EVENT)
        df = df.dropDuplicates(["rep", "attempt"]).coalesce(1)
        df.write.mode("append").parquet(arriving)
        seen.append(spark.createDataFrame(df.collect(), EVENT))
        stream_ledger(spark.readStream.schema(df.schema).parquet(arriving), base, check).awaitTermination()
        folders.append(len(os.listdir(f"{base}/data")) + len(os.listdir(f"{base}/snapshots")))
    want = sets.latest_state(sets.union_all(seen), key)
    got = {(r["rep"], r["attempt"], r["exit_code"]) for r in read_ledger(spark, base).collect()}
    assert got and {r[:2] for r in got} == {(r["rep"], r["attempt"]) for r in want.collect()}
    assert max(folders) <= 20 and folders[-1] < 13
    assert "RocksDB" in "".join(open(f"{check}/offsets/{n}").read() for n in os.listdir(f"{check}/offsets") if not n.startswith("."))


def test_replication_counts_each_replicate_once(spark, tmp_path):
    arriving, base, check = (str(tmp_path / n) for n in ("in", "counts", "check"))
    schema = "population string, maf double, nqtl int, effect string, h2 double, algorithm string, pca boolean, rep int"
    for reps in ((1, 2, 2), (2, 3)):
        df = spark.createDataFrame([("p", 0.05, 5, "gamma", 0.3, "inbred", True, r) for r in reps], schema)
        df.write.mode("append").parquet(arriving)
        stream_replication(spark.readStream.schema(df.schema).parquet(arriving), base, check).awaitTermination()
    row = read_replication(spark, base, 3).first()
    assert row["n_reps"] == 3 and row["complete"]


def test_older_and_current_path_find_the_same_peaks(spark):
    """With known, non-zero scores only, both paths must agree on every interval."""
    from locuspark.operators import legacy
    from locuspark.operators.intervals import detect
    from locuspark.plans.legacy import legacy_intervals

    rng = random.Random(11)
    rows = [
        (f"m{k}", f"{c}:{x * 10}", 0.1, 0.2, 0.3, rng.choice([1e-9, 1e-7, *[0.2, 0.4, 0.8] * 6]))
        for k in range(6)
        for c in ("1", "2")
        for x in range(1, 60)
    ]
    mappings = spark.createDataFrame(
        rows, "mapping_id string, marker string, AF1 double, BETA double, SE double, P double"
    )
    meta = spark.createDataFrame(
        [(f"m{k}", "t", "s") for k in range(6)], "mapping_id string, trait_id string, marker_set_id string"
    )
    phenotypes = spark.createDataFrame(
        [("t", f"n{i}", float(i)) for i in range(4)], "trait_id string, strain string, phenotype double"
    )
    geno = spark.createDataFrame(
        [("s", c, x * 10, f"n{i}", 1.0 if i % 2 else -1.0) for c in ("1", "2") for x in range(1, 60, 2) for i in range(4)],
        "marker_set_id string, CHROM string, POS int, strain string, allele double",
    )
    older = legacy_intervals(
        mappings, meta, geno, phenotypes, "USER", ci_size=2, snp_grouping=3, max_share=1.0, user=5.0
    )
    limits = legacy.legacy_thresholds(mappings, "USER", user=5.0)
    _peaked, peaks = detect(mappings, limits, 2, 3)
    columns = ["mapping_id", "peak_id", "startPOS", "peakPOS", "endPOS", "interval_size"]
    want = {tuple(r) for r in peaks.select(*columns).collect()}
    got = {tuple(r) for r in older.where("peak_id is not null").select(*columns).collect()}
    assert got == want and want
    hits = older.where("aboveBF = 1")
    assert hits.count() == 4 * hits.select("mapping_id", "marker").distinct().count()
    typed = hits.where("var_exp is not null").select("marker").distinct().collect()
    assert all((int(r[0].split(":")[1]) // 10) % 2 == 1 for r in typed)
    guarded = legacy_intervals(
        mappings, meta, geno, phenotypes, "USER", ci_size=2, snp_grouping=3, max_share=0.001, user=5.0
    )
    assert guarded.count() == len(rows) and guarded.where("peak_id is not null or strain is not null").isEmpty()


def test_marker_set_build_matches_a_plain_loop(spark, tmp_path):
    from locuspark.plans.marker_set import build_marker_set

    rng = random.Random(9)
    names = [f"s{i}" for i in range(9)]
    calls, lines = {}, []
    previous = None
    for i in range(40):
        chrom, pos = ("MtDNA" if i % 13 == 0 else "II"), (i + 1) * 10
        gts = [rng.choice(["0/0", "1|1"]) for _ in names]
        if previous and rng.random() < 0.5:
            gts = list(previous)
        previous = list(gts)
        if i % 7 == 0:
            gts[rng.randrange(9)] = "./."
        elif i % 3 == 0:
            gts[rng.randrange(8)] = "0/1"
        ref, alt = ("AT" if i % 11 == 0 else "A"), ("G,T" if i % 17 == 0 else "G")
        calls[chrom, pos] = (ref, alt, gts)
        lines.append("\t".join([chrom, str(pos), ".", ref, alt, ".", "PASS", ".", "GT", *gts]))
    header = "##contig=<ID=I>\n##contig=<ID=II>\n##contig=<ID=MtDNA>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    path = tmp_path / "x.vcf"
    path.write_text(header + "\t".join(names) + "\n" + "\n".join(lines) + "\n")

    kept = names[:8]  # the last sample is left out, with its missing calls
    good = []
    for (chrom, pos), (ref, alt, gts) in calls.items():
        mine = gts[:8]
        dosage = [{"0/0": 0.0, "0/1": 1.0, "1|1": 2.0}.get(g) for g in mine]
        freq = sum(x or 0 for x in dosage) / 16
        if chrom == "II" and ref == "A" and alt == "G" and "./." not in mine and min(freq, 1 - freq) >= 0.2:
            good.append((pos, dosage))
    matrix = np.array([g for _p, g in good])
    pruned = {good[p // 10 - 1][0] for p in prune_by_hand(matrix, 0.6, 50, 10, maf=[min(sum(g), 16 - sum(g)) for _p, g in good])}
    samples = spark.createDataFrame([(n,) for n in kept], "strain string")
    for limit, gone in ((1.0, set()), (0.6, pruned)):
        markers, genotypes = build_marker_set(spark, str(path), samples, "set", 0.2, limit)
        code = {0.0: -1.0, 1.0: None, 2.0: 1.0}
        want = {("2", p, n): code[a] for p, line in good if p not in gone for n, a in zip(kept, line)}
        assert {(r.CHROM, r.POS, r.strain): r.allele for r in genotypes.collect()} == want
        assert {r.marker for r in markers.collect()} == {f"2:{p}" for p, _l in good if p not in gone}
    assert pruned and len(pruned) < len(good)


def test_registry():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 171


def test_flagship(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "peak_id" in df.columns


def test_encoded_files_are_not_broadcast(spark, tmp_path):
    """A few MB of encoded files are tens of MB in rows; those do not go through the driver."""
    ids = spark.range(300_000).withColumn("work_dir", F.concat(F.lit("w"), F.col("id").cast("string"))).drop("id")
    parts = {
        "tasks": ids.withColumns({"process": F.lit("GCTA_PERFORM_GWA"), "tag": F.lit("ce.n100_r1")}),
        "usage": ids.withColumn("total_bytes", F.lit(1e6)),
        "files": ids.withColumns({"kind": F.lit("f"), "bytes": F.lit(10.0), "file_name": F.lit("a.n90_1.tsv")}),
    }
    for name, rows in parts.items():
        rows.write.parquet(str(tmp_path / name))
    tasks, usage, files = [spark.read.parquet(str(tmp_path / name)) for name in parts]
    joined = workdir.join_workdir(tasks, usage, files).agg(F.count(F.lit(1)).alias("n"), F.max(F.hash("*")))
    assert joined.collect()[0].n == 300_000
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_top_processes_reads_its_totals_once(spark):
    later = F.udf(lambda _: time.time_ns(), "long").asNondeterministic()
    stats = spark.range(0, 20, 1, 1).select("id", later("id").alias("total_gb_sum"))
    assert workdir.top_processes(stats, 3).count() == 3


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name)
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    kept = stage(counted.join(counted.withColumnRenamed("count", "again"), "k"), "counted")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == 10 and counted.count() == 10 and spark.conf.get(name) == setting
