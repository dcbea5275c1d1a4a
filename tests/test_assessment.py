"""Assessment rules that everyday data rarely touches."""

from __future__ import annotations

import pytest

from locuspark.plans.assess import compile_assessment
from locuspark.operators.intervals import detect
from locuspark.schemas import ASSESSMENT

MAPPING = "mapping_id string, marker string, AF1 double, BETA double, SE double, P double"
META = (
    "mapping_id string, trait_id string, nqtl int, rep int, h2 double, maf double, effect string, "
    "population string, algorithm string, pca boolean"
)
CAUSAL = (
    "trait_id string, QTL string, CHROM string, POS int, RefAllele string, Frequency double, Effect double"
)


def build(spark, hits, causal, width=1_000_000):
    rows = []
    for mapping, places in hits.items():
        rows += [
            (mapping, f"I:{(i + 1) * 1000}", 0.2, 0.1, 0.05, 1e-8 if i in places else 0.5)
            for i in range(30)
        ]
    mappings = spark.createDataFrame(rows, MAPPING)
    meta = spark.createDataFrame(
        [(m, f"t_{m}", 5, 1, 0.3, 0.05, "gamma", "p", "inbred", True) for m in hits], META
    )
    variants = [
        (f"t_{m}", q, *q.split(":")[:1], int(q.split(":")[1]), "A", 0.1, 0.2)
        for m, qs in causal.items()
        for q in qs
    ]
    limits = spark.createDataFrame(
        [(m, "USER", 5.0) for m in hits],
        "mapping_id string, sig_threshold_method string, sig_threshold_value double",
    )
    _peaked, peaks = detect(mappings, limits, 2, 3, width)
    out = compile_assessment(
        mappings, limits, peaks, meta, spark.createDataFrame(variants, CAUSAL), 0.05, 2, 3
    )
    return out


@pytest.fixture(scope="module")
def assessed(spark):
    hits = {"a": [5, 20], "no_causal": [5], "no_peaks": [], "off_marker": [5], "between": [5, 9]}
    causal = {
        "a": ["I:6000", "I:28000"],
        "no_peaks": ["I:6000"],
        "off_marker": ["I:6500", "I:25500"],
        "between": ["I:8000"],
    }
    out = build(spark, hits, causal)
    assert out.columns == ASSESSMENT.names
    # The mapping is recognised by its causal set; label rows through the QTL and peak.
    return out.collect()


def pick(rows, **want):
    return [r for r in rows if all(r[k] == v for k, v in want.items())]


def test_true_positive_and_false_positive(assessed):
    hit = pick(assessed, QTL="I:6000", Detected=True, Simulated=True)
    assert len(hit) == 1 and hit[0]["top_hit"] is True and hit[0]["peak_id"] == 1
    false = pick(assessed, Simulated=False)
    assert [r["QTL"] for r in false] == ["I:21000"]
    assert false[0]["log10p"] is None and false[0]["Effect"] is None and false[0]["top_hit"] is True


def test_trait_without_causal_variants_yields_nothing(assessed):
    # Five mappings, one of them without causal variants: its peak is no false positive.
    assert len(pick(assessed, Simulated=False)) == 1


def test_missed_variant_keeps_nulls(assessed):
    missed = pick(assessed, QTL="I:6000", Detected=False)
    assert len(missed) == 1 and missed[0]["peak_id"] is None and missed[0]["top_hit"] is None


def test_untested_variant(assessed):
    inside = pick(assessed, QTL="I:6500")[0]
    assert inside["Detected"] and inside["log10p"] is None and inside["significant"] is None
    outside = pick(assessed, QTL="I:25500")[0]
    assert not outside["Detected"] and outside["significant"] is None


def test_variant_in_two_intervals_keeps_the_first_peak(assessed):
    rows = pick(assessed, QTL="I:8000")
    assert len(rows) == 1 and rows[0]["peak_id"] == 1


def test_text_parameters(assessed):
    row = assessed[0]
    assert (row["nQTL"], row["h2"], row["maf"], row["type"]) == ("5", "0.3", "0.05", "pca")
    assert row["algorithm_id"] == "inbred_PCA_USER"


def test_range_join_over_block_borders(spark):
    """An interval over many blocks finds its variant exactly once."""
    out = build(spark, {"m": [5]}, {"m": ["I:6000", "I:7900", "I:4000", "I:3999"]}, width=500)
    from locuspark.operators import causal as C

    peaks = spark.createDataFrame(
        [("m", "USER", "I", 4000, 6000, 8000, "I:6000", 0.1, 8.0, 0.2, 1, 4000)],
        "mapping_id string, sig_threshold_method string, CHROM string, startPOS int, peakPOS int, endPOS int, "
        "peak_marker string, peak_BETA double, max_log10p double, peak_AF1 double, peak_id int, interval_size int",
    )
    scored = spark.createDataFrame(
        [("m", "USER", f"I:{p}", "I", p) for p in (3999, 4000, 6000, 8000, 8001)],
        "mapping_id string, sig_threshold_method string, QTL string, CHROM string, POS int",
    )
    found = C.peak_causal_overlaps(peaks, scored, width=500)
    assert sorted(r["POS"] for r in found.collect()) == [4000, 6000, 8000]
    assert {r["QTL"]: r["Detected"] for r in out.collect()} == {
        "I:6000": True,
        "I:7900": True,
        "I:4000": True,
        "I:3999": False,
    }
