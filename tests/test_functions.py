"""Identifiers, names, scores, variance explained and outcomes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from locuspark.functions import (
    interval_jaccard,
    mapping_id,
    marker_set_id,
    normalize_species,
    output_name,
    parse_effect,
    parse_mapping_name,
    release_id,
    safe_log10p,
    trait_id,
    with_ids,
)
from locuspark.operators import performance, variance


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit(v):
    return F.lit(v)


def test_identifier_goldens(spark):
    made = marker_set_id(lit("ce.test"), lit(0.05), lit("c_elegans"), lit("20220216"), lit(0.8))
    parent = one(spark, made["hash"])
    assert parent == "db39e634ef0bfa76e1bd"
    trait = one(
        spark,
        trait_id(lit(parent), lit(5), lit("gamma"), lit(1), lit(0.8), lit(0.05), lit(0.8))["hash"],
    )
    assert trait == "5a068bb1a67b5e6ba41d"
    assert one(spark, mapping_id(lit(trait), lit("inbred"), lit(True))["hash"]) == "0b8f4ba93b6ac58d2fce"


def test_names_are_normalised_before_hashing(spark):
    a = marker_set_id(lit(" CE.test "), lit(0.05), lit("C_Elegans"), lit("20220216"), lit(0.8))
    assert one(spark, a["hash"]) == "db39e634ef0bfa76e1bd"


def test_bad_parent_and_null_parameters_fail(spark):
    with pytest.raises(Exception, match="not a parent identifier"):
        one(spark, mapping_id(lit("XYZ"), lit("inbred"), lit(True))["hash"])
    grid = spark.createDataFrame(
        [("p", 0.05, "c_elegans", "20220216", 0.8, 5, "gamma", 1, None, 0.05, 0.8)],
        "population string, maf double, species string, vcf_release_id string, ms_ld double, nqtl int, "
        "effect string, rep int, h2 double, cv_maf_effective double, cv_ld double",
    )
    with pytest.raises(Exception, match="missing id parameters: h2"):
        with_ids(grid, include_mapping=False).collect()


def test_scores(spark):
    values = [0.0, 1.0, 1e-5, None, float("nan"), float("inf"), 5e-324]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    got = [r[0] for r in rows.orderBy("i").select(safe_log10p(F.col("p"))).collect()]
    assert got[:6] == [300.0, 0.0, 5.0, None, None, 300.0]
    assert got[6] > 323


def test_mapping_names(spark):
    good = "x/5_1_0.8_0.05_gamma_ce.test_processed_LMM-EXACT-INBRED_PCA_mapping_reprocessed.tsv"
    row = one(spark, parse_mapping_name(lit(good)))
    assert row.asDict() == {
        "nqtl": 5,
        "rep": 1,
        "h2": 0.8,
        "maf": 0.05,
        "effect": "gamma",
        "population": "ce.test",
        "algorithm": "INBRED",
        "pca": True,
    }
    ranged = "5_1_0.8_0.05_0.2-0.3_ce.test_processed_LMM-EXACT-LOCO_mapping.tsv"
    assert one(spark, parse_mapping_name(lit(ranged))) is None


def test_small_parsers(spark):
    assert one(spark, output_name(lit("a/b.tsv"))) == "b_reprocessed.tsv"
    assert one(spark, release_id(lit("/v/WI.20220216.vcf.gz"))) == "20220216"
    assert tuple(one(spark, parse_effect(lit("0.2-0.3")))) == ("uniform", 0.2, 0.3)
    assert one(spark, parse_effect(lit("normal"))) is None
    assert one(spark, normalize_species(lit(" C_Elegans "))) == "c_elegans"
    with pytest.raises(Exception, match="unknown species"):
        one(spark, normalize_species(lit("human")))
    assert one(spark, interval_jaccard(lit(5), lit(5), lit(5), lit(5))) == 1.0
    assert one(spark, interval_jaccard(lit(0), lit(10), lit(20), lit(30))) == 0.0


ALLELES = {
    "1:100": [-1, 1, -1, 1],
    "2:300": [-1, -1, 1, 1],
    "3:500": [-1, -1, -1, 1],
    "4:mono": [1, 1, 1, 1],
    "5:null": [None, None, None, 1],
}
PHENOTYPE = [2.5, 3.8, 2.1, 4.0]


def test_variance_explained_goldens(spark):
    rows = [
        ("t", q, f"s{i}", None if a is None else float(a), PHENOTYPE[i])
        for q, codes in ALLELES.items()
        for i, a in enumerate(codes)
    ]
    joined = spark.createDataFrame(
        rows, "trait_id string, QTL string, strain string, allele double, phenotype double"
    )
    got = {r["QTL"]: r["Simulated_QTL_VarExp"] for r in variance.variance_explained(joined).collect()}
    assert got["1:100"] == pytest.approx(2.56 / 2.66)
    assert got["2:300"] == pytest.approx(0.01 / 2.66)
    assert got["3:500"] is None and got["4:mono"] is None and got["5:null"] is None
    flat = joined.withColumn("phenotype", F.lit(1.0))
    assert {r[2] for r in variance.variance_explained(flat).collect()} == {None}


def test_outcomes(spark):
    cases = [
        (True, True, 1, "Detected.CV"),
        (True, True, None, "Detected.CV"),
        (True, False, 0, "Missed.CV"),
        (True, False, None, "Missed.CV"),
        (True, True, 0, "CV.Not.Significant.In.Interval"),
        (False, True, None, "False.Discovery"),
        (True, False, 1, None),
        (False, False, None, None),
    ]
    df = spark.createDataFrame(cases, "Simulated boolean, Detected boolean, significant int, want string")
    for row in performance.designate(df).collect():
        assert row["designation"] == row["want"]
    renamed = df.withColumnRenamed("significant", "aboveBF")
    assert all(r["designation"] == r["want"] for r in performance.designate(renamed).collect())
    with pytest.raises(ValueError):
        performance.designate(df.drop("significant"))


def test_power_and_fdr(spark):
    counts = spark.createDataFrame(
        [("a", 2, 1, 1, 1), ("empty", 0, 0, 0, 0)],
        "g string, Detected_CV long, Missed_CV long, CV_Not_Significant_In_Interval long, False_Discovery long",
    )
    loose = {r["g"]: r for r in performance.power_fdr(counts).collect()}
    assert (loose["a"]["Power"], loose["a"]["FDR"]) == (0.75, 0.25)
    assert (loose["empty"]["Power"], loose["empty"]["FDR"]) == (0.0, 0.0)
    strict = {r["g"]: r for r in performance.power_fdr(counts, stringent=True).collect()}
    assert strict["a"]["Power"] == 0.5
    only = {r["g"]: r for r in performance.power_only(counts).collect()}
    assert only["a"]["Detected"] == 3 and "False_Discovery" not in only["a"].asDict()


def test_a_name_is_matched_once(spark):
    """All fields come from one match; text after the name, as a line end, is no part of the last group."""
    from locuspark.functions.names import parse_mapping_name, parse_result_name

    names = ["/d/5_1_0.8_0.05_gamma_ce.p_processed_LMM-EXACT-LOCO_PCA_mapping.tsv", "5_1_0.8_._gamma_a_b_processed_LMM-EXACT-INBRED_mapping_reprocessed.tsv", "x", "", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(parse_mapping_name(F.col("n")).alias("p")).select("p.*")
    assert [tuple(r) for r in df.collect()] == [
        (5, 1, 0.8, 0.05, "gamma", "ce.p", "LOCO", True),
        (5, 1, 0.8, None, "gamma", "a_b", "INBRED", False),
        *[(None,) * 8] * 3,
    ]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_processed_LMM") == 1, plan
    line = spark.createDataFrame([("5_1_0.8_0.05_gamma_p_lmm-exact_loco_pca\n.mlma",)], "n string")
    assert line.select(parse_result_name(F.col("n")).alias("p")).first().p.pca is True
