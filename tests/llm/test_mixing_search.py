from __future__ import annotations

import itertools
import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from locuspark.llm import mixing, topk
from tests.llm.conftest import ODD


def test_targets_share_excess_again():
    sizes = {"a": 10, "b": 1000, "c": 100, None: 0}
    weights = mixing.cyclic_weights(list(sizes))
    assert weights == {"a": 1, "b": 2, "c": 3, None: 1}
    got = mixing.targets(sizes, weights, 1110)
    assert got == {"a": 30, None: 0, "c": 300, "b": 780} and sum(got.values()) == 1110
    assert mixing.targets({"a": 6, "b": 6}, {"a": 1, "b": 2}, 12) == {"a": Fraction(4), "b": Fraction(8)}


def test_flow_costs_as_little_as_any():
    rng = random.Random(3)
    for _ in range(25):
        words = [rng.randint(1, 3) for _ in range(3)]
        members = [rng.sample(range(2), rng.randint(1, 2)) for _ in range(3)]
        quotas = [rng.randint(0, 6) for _ in range(2)]
        got = mixing.min_cost_flow(words, members, quotas)

        def cost(given):
            return sum(c * max(0, min(w, g - k * w)) for w, g in zip(words, given) for k, c in enumerate(mixing.COSTS))

        def fits(given):  # Hall's condition for two sources
            only = [sum(g for g, m in zip(given, members) if m == [s]) for s in range(2)]
            return all(o <= q for o, q in zip(only, quotas)) and sum(given) <= sum(quotas)

        options = [g for g in itertools.product(*[range(3 * w + 1) for w in words]) if fits(g)]
        most = max(map(sum, options))
        assert fits(got) and sum(got) == most and cost(got) == min(cost(g) for g in options if sum(g) == most)


def test_mix_meets_targets_and_repeats_itself(table):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(1, 60), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    got = mixing.mix(table(rows), F.array("source")).select("doc_id", "source", "mix_size", "mix_copies", F.col("mix_sources")[0]["target"].alias("target")).collect()
    taken, goal = {}, {}
    for r in got:
        assert r.mix_copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.mix_size * r.mix_copies
        goal[r.source] = r.target
    off = {s: taken[s] - goal[s] for s in goal}
    assert max(map(abs, off.values())) <= 5, off
    again = mixing.mix(table(rows[::-1]).repartition(5), F.array("source")).select("doc_id", "mix_copies")
    assert {tuple(r) for r in again.collect()} == {(r.doc_id, r.mix_copies) for r in got}


def test_mix_odd_rows_and_overlap(table):
    got = mixing.mix(table(ODD), F.array("source")).collect()
    assert len(got) == len(ODD) and all(r.mix_size == len((r.text or "").encode().replace(b"\xe3\x80\x80", b"x").split()) or r.doc_id == 6 for r in got)
    assert mixing.mix(table([]), F.array("source")).count() == 0
    rows = [(i, "w w w w", "en", "a") for i in range(40)] + [(100 + i, "w w", "en", "b") for i in range(40)]
    both = mixing.mix(table(rows), F.when(F.col("doc_id") < 20, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source")), weights={"a": 1, "b": 1})
    assert sum(r.mix_size * r.mix_copies for r in both.collect()) == 240
    assert mixing.mixed(table(ODD)).columns == table(ODD).columns


def test_top_k_against_all_products(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=16) * rng.choice([0.1, 1, 3])).tolist(), i) for i in range(700)]
    rows += [(700 + i, rows[i][1], 0) for i in range(40)]  # ties
    rows += [(800, None, 0), (801, [1.0, None], 0), (802, [float("nan")], 0), (803, [float("inf")], 0), (804, [], 0), (805, [2.0], 0), (None, [1.0], 0), (5, rows[9][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(frame, F.col("vec_id") % 7 == 0, 5).collect()}
    good = [(i, np.pad(np.floor(np.array(v, float) * 256), (0, 16 - len(v))).astype(int)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want, asked = {}, set()
    for q, v in good:
        if q % 7 == 0 and q not in asked:
            asked.add(q)
            best = sorted((-int(v @ w), i) for i, w in good if i != q)[:5]
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 7 == 0).count() == 0
    few = topk.top_k(frame.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.query_id) for r in sorted(few, key=lambda r: r.rank)] == [(1, 0), (2, 0)]
