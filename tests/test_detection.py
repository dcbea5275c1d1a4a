"""Flags, peaks and intervals: unit cases, block borders and a plain-Python check."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from locuspark.operators import blocks, intervals, regions, thresholds

LOW, HIGH = 0.5, 1e-8
MAPPING = "mapping_id string, marker string, AF1 double, BETA double, SE double, P double"
CUT = 5.0


def chromosome(n, chrom="I", hits=(), step=1000):
    values = hits if isinstance(hits, dict) else dict.fromkeys(hits, HIGH)
    return [
        (f"{chrom}:{(i + 1) * step}", 0.2, 0.1, 0.05, values.get(i, LOW)) for i in range(n)
    ]


CASES = {
    "none": chromosome(20),
    "single": chromosome(20, hits=[9]),
    "adjacent": chromosome(20, hits=[4, 5, 6]),
    "distant": chromosome(20, hits=[2, 15]),
    "two_chromosomes": chromosome(10, "I", [9]) + chromosome(10, "II", [0]),
    "all": chromosome(10, hits=range(10)),
    "left_edge": chromosome(20, hits=[1]),
    "right_edge": chromosome(20, hits=[18]),
    "top_marker": chromosome(20, hits={5: 1e-6, 6: 1e-9, 7: 1e-7}),
    "tie": chromosome(20, hits={5: 1e-9, 6: 1e-9}),
    "zero_p": chromosome(20, hits={5: 0.0, 6: 1e-9}),
    "boundary": chromosome(20, hits={5: 1e-5}),
    "just_below": chromosome(20, hits={5: 1.0000001e-5}),
    "unknown_p": chromosome(20, hits={5: None, 6: float("nan")}),
    "gap_two": chromosome(20, hits=[5, 7]),
    "gap_three": chromosome(20, hits=[5, 8]),
    "text_order": chromosome(5, "10", [2]) + chromosome(5, "2", [2]),
}


@pytest.fixture(scope="module")
def results(spark):
    rows = [(name, *row) for name, case in CASES.items() for row in case]
    random.Random(1).shuffle(rows)
    mappings = spark.createDataFrame(rows, MAPPING)
    limits = spark.createDataFrame(
        [(name, "USER", CUT) for name in CASES],
        "mapping_id string, sig_threshold_method string, sig_threshold_value double",
    )
    analyzed = intervals.analyze(mappings, limits, ci_size=2, snp_grouping=3, width=4000).collect()
    out = {name: [] for name in CASES}
    for row in analyzed:
        out[row["mapping_id"]].append(row)
    for rows_ in out.values():
        rows_.sort(key=lambda r: (r["CHROM"], r["POS"]))
    return out


def peaks(rows):
    return {r["peak_id"]: (r["startPOS"], r["peakPOS"], r["endPOS"]) for r in rows if r["peak_id"]}


def test_every_row_is_kept(results):
    assert all(len(results[n]) == len(CASES[n]) for n in CASES)


def test_no_significant_marker_gives_nulls(results):
    rows = results["none"]
    assert all(r["significant"] == 0 and r["peak_id"] is None and r["startPOS"] is None for r in rows)


def test_single_marker(results):
    assert peaks(results["single"]) == {1: (8000, 10000, 12000)}


def test_adjacent_markers_share_a_peak(results):
    assert peaks(results["adjacent"]) == {1: (3000, 5000, 9000)}


def test_distant_markers_split(results):
    assert peaks(results["distant"]) == {1: (1000, 3000, 5000), 2: (14000, 16000, 18000)}


def test_chromosomes_never_share_a_peak(results):
    assert peaks(results["two_chromosomes"]) == {1: (8000, 10000, 10000), 2: (1000, 1000, 3000)}


def test_all_significant(results):
    assert peaks(results["all"]) == {1: (1000, 1000, 10000)}


def test_intervals_stop_at_the_chromosome_ends(results):
    assert peaks(results["left_edge"])[1][0] == 1000
    assert peaks(results["right_edge"])[1][2] == 20000


def test_peak_is_the_highest_marker(results):
    assert peaks(results["top_marker"]) == {1: (4000, 7000, 10000)}


def test_tie_goes_to_the_first_marker(results):
    assert peaks(results["tie"])[1][1] == 6000


def test_zero_p_scores_300(results):
    row = next(r for r in results["zero_p"] if r["POS"] == 6000)
    assert row["log10p"] == 300.0 and row["significant"] == 1
    assert peaks(results["zero_p"])[1][1] == 6000


def test_flag_is_inclusive(results):
    assert len(peaks(results["boundary"])) == 1
    assert not peaks(results["just_below"])


def test_unknown_p_is_neither(results):
    unknown = [r for r in results["unknown_p"] if r["POS"] in (6000, 7000)]
    assert all(r["log10p"] is None and r["significant"] is None for r in unknown)
    assert not peaks(results["unknown_p"])


def test_gap_below_grouping_keeps_the_peak(results):
    assert len(peaks(results["gap_two"])) == 1
    assert len(peaks(results["gap_three"])) == 2


def test_peaks_are_numbered_in_text_order_of_chromosomes(results):
    rows = [r for r in results["text_order"] if r["peak_id"]]
    assert {r["CHROM"]: r["peak_id"] for r in rows} == {"10": 1, "2": 2}


def by_hand(rows, cut, ci, grouping):
    """Peaks of one mapping from a plain loop."""
    found, chroms = [], {}
    for marker, *_rest, p in rows:
        chrom, pos = marker.split(":")
        score = None if p is None else 300.0 if p == 0 else -math.log10(p)
        chroms.setdefault(chrom, []).append((int(pos), score, marker))
    peak = 0
    for chrom in sorted(chroms):
        line = sorted(chroms[chrom])
        previous = None
        groups = []
        for i, (_pos, score, _m) in enumerate(line):
            if score is None or score < cut:
                continue
            if previous is None or i - previous >= grouping:
                groups.append([])
            groups[-1].append(i)
            previous = i
        for g in groups:
            peak += 1
            top = max(g, key=lambda i: (line[i][1], -i))
            lo, hi = max(g[0] - ci, 0), min(g[-1] + ci, len(line) - 1)
            found.append((peak, chrom, line[lo][0], line[top][0], line[hi][0], len(g), line[top][2]))
    return found


@pytest.mark.parametrize("width", [700, 1_000_000])
def test_random_mappings_match_a_plain_loop(spark, width):
    rng = random.Random(7)
    rows, want = [], []
    for k in range(25):
        mine = []
        for chrom in ("1", "10", "2"):
            places = sorted(rng.sample(range(1, 5000), rng.randint(1, 60)))
            mine += [
                (f"{chrom}:{x}", 0.1, 0.2, 0.3, rng.choice([1e-7, 1e-6, 0.0, None, 0.3, 0.5, 0.9]))
                for x in places
            ]
        rows += [(f"m{k}", *r) for r in mine]
        want += [(f"m{k}", *p) for p in by_hand(mine, 5.0, 3, 4)]
    mappings = spark.createDataFrame(rows, MAPPING)
    limits = mappings.select("mapping_id").distinct().select(
        "mapping_id", F.lit("USER").alias("sig_threshold_method"), F.lit(5.0).alias("sig_threshold_value")
    )
    _peaked, found = intervals.detect(mappings, limits, 3, 4, width)
    got = [
        (r.mapping_id, r.peak_id, r.CHROM, r.startPOS, r.peakPOS, r.endPOS, r.n_sig_markers, r.peak_marker)
        for r in regions.regions_from_peaks(found).collect()
    ]
    assert sorted(got) == sorted(want)


def test_hot_mapping_is_spread_over_many_groups(spark):
    """A mapping with most of all rows splits into blocks of bounded size."""
    hot = spark.range(20_000).select(F.lit("hot").alias("mapping_id"), F.lit("1").alias("CHROM"), (F.col("id") * 5).cast("int").alias("POS"))
    rest = spark.range(1_000).select(F.concat(F.lit("m"), F.col("id") % 50).alias("mapping_id"), F.lit("1").alias("CHROM"), F.col("id").cast("int").alias("POS"))
    index = blocks.position_index(hot.unionByName(rest), width=1000)
    largest = index.agg(F.max(F.size("_positions"))).first()[0]
    assert largest <= 1000
    assert index.where("mapping_id = 'hot'").count() == 100
    ranked = blocks.marker_index(
        hot.withColumn("marker", F.col("POS").cast("string")), width=1000
    ).where(F.col("marker_index") != F.col("POS") / 5 + 1)
    assert ranked.isEmpty()


def test_unknown_method_fails(spark):
    with pytest.raises(ValueError, match="unknown significance method"):
        thresholds.mapping_thresholds(None, None, None, ["NOPE"])


def test_missing_test_count_fails_or_is_reported(spark):
    meta = spark.createDataFrame([("m", "s")], "mapping_id string, marker_set_id string")
    sets = spark.createDataFrame(
        [("s", 10, None)], "marker_set_id string, n_markers int, n_independent_tests double"
    )
    rows = spark.createDataFrame([("m",)], "mapping_id string")
    assert thresholds.mapping_thresholds(rows, meta, sets, ["EIGEN"], missing="skip").isEmpty()
    with pytest.raises(Exception, match="no test count for m EIGEN"):
        thresholds.mapping_thresholds(rows, meta, sets, ["EIGEN"]).collect()
    with pytest.raises(ValueError, match="fail or skip"):
        thresholds.mapping_thresholds(rows, meta, sets, missing="drop")
    more = meta.unionByName(spark.createDataFrame([("unknown", "none"), ("zero", "z")], meta.schema))
    sets = sets.unionByName(spark.createDataFrame([("z", 0, 0.0)], sets.schema))
    found = thresholds.missing_thresholds(rows, more, sets)
    assert sorted(map(tuple, found.collect())) == [
        ("m", "EIGEN", "no test count"), ("unknown", "BF", "no test count"), ("unknown", "EIGEN", "no test count"),
        ("zero", "BF", "no test count"), ("zero", "EIGEN", "no positive test count"),
    ]
    found = thresholds.missing_thresholds(rows, more, sets, ["BF"], bf_count="marker_set")
    assert sorted(map(tuple, found.collect())) == [("unknown", "BF", "no test count"), ("zero", "BF", "no positive test count")]


def test_interval_borders_over_many_blocks(spark):
    """Borders equal plain Python across block and bucket borders, without a list of all blocks of a chromosome."""
    rng = random.Random(7)
    places = {("m1", "1"): sorted(rng.sample(range(1, 400_000), 3000)), ("m1", "2"): [5, 900, 70_000], ("m2", "1"): list(range(10, 26_000, 10))}
    rows = [(m, c, p) for (m, c), ps in places.items() for p in ps]
    index = blocks.position_index(spark.createDataFrame(rows, "mapping_id string, CHROM string, POS int"), width=2000)
    ranges = []
    for (m, c), ps in places.items():
        for i in {1, len(ps), *(rng.randint(1, len(ps)) for _ in range(60)), *(i for i in (1023, 1024, 1025, 2048, 2049) if i <= len(ps))}:
            ranges.append((m, c, i, min(len(ps), i + rng.randint(0, 40)), len(ps)))
    peaks = spark.createDataFrame(ranges, "mapping_id string, CHROM string, _min_index int, _max_index int, _total long")
    found = intervals.interval_bounds(peaks, index, 7, keys=("mapping_id",))
    want = sorted(
        (m, c, a, b, n, places[m, c][max(a - 7, 1) - 1], places[m, c][min(b + 7, n) - 1]) for m, c, a, b, n in ranges
    )
    assert sorted(tuple(r)[:7] for r in found.collect()) == want
    assert "lambdafunction" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_repeated_markers_share_a_peak(spark, monkeypatch):
    """Every copy of a marker that opens a peak is in it, in whichever order a join leaves the copies."""
    at = [3, 4, 30, 31, 60, 90, 91]
    rows = [("m", "BF", "1", 1000 * i, i, copy) for i in at for copy in range(3)]
    hits = spark.createDataFrame(rows, "mapping_id string, sig_threshold_method string, CHROM string, POS long, marker_index int, copy int")
    want = {i: 1 + sum(i >= first for first in (30, 60, 90)) for i in at}
    join = type(hits).join
    for hint in (None, "broadcast", "shuffle_hash", "merge"):
        # A hash join that is built on the markers turns the order of their copies around.
        monkeypatch.setattr(type(hits), "join", lambda a, b, *on: join(a.hint(hint) if hint else a, b, *on))
        got = intervals.assign_peaks(hits, 5, width=20_000).collect()
        assert len(got) == len(rows) and all(r["peak_id"] == want[r["marker_index"]] for r in got), hint
