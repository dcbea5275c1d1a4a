from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from locuspark.llm import exact_dedup, near_dedup
from tests.llm.conftest import ODD


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def exact_by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        left = 1
        for i in ids:
            kept = bool(i == keep and left)
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def test_exact_dedup_odd_rows(table):
    rows = [*ODD, (9, "a  b"), (8, "a\tb"), (7, "a b "), (10, "a\n\nb")]
    assert Counter(map(tuple, exact_dedup.exact_dedup(table(rows)).collect())) == exact_by_hand(rows)


def test_exact_dedup_survives_hash_collisions(table):
    rng = random.Random(1)
    rows = [(i, rng.choice(["ax", "ay", "az", "bx", "by", "c"])) for i in range(60)]
    weak = exact_dedup.exact_dedup(table(rows), hash_of=lambda c: F.substring(c, 1, 1).cast("binary"))
    assert Counter(map(tuple, weak.collect())) == exact_by_hand(rows)


def test_exact_dedup_empty_and_kept_rows(table):
    assert exact_dedup.exact_dedup(table([])).count() == 0
    kept = exact_dedup.keep_first(table([*ODD, (20, "one")]))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6]
    assert "pattern" in kept.columns


REPEATS = [(None, "first text without id"), (None, "second text without id"), (7, "one text of seven"), (7, "another text of seven"), (7, "one  text of seven"), (3, "another text of seven")]


def test_rows_with_one_id_and_different_texts_stay(table):
    """Null and repeated ids are no reason to drop a text, or to keep a copy."""
    want = Counter([(None, "first text without id"), (None, "second text without id"), (7, "one text of seven"), (3, "another text of seven")])
    for keep in (exact_dedup.keep_first, near_dedup.keep_one):
        assert Counter((r.doc_id, norm(r.text)) for r in keep(table(REPEATS)).collect()) == want


def test_near_copies_with_one_id_leave_one_row(table):
    words = [f"w{k}" for k in range(60)]
    near = [" ".join(words), " ".join([*words, "end"])]
    rows = [*[(None, t) for t in near], *[(8, t.upper()) for t in near], (None, "alone"), (None, ""), (8, "")]
    kept = Counter((r.doc_id, r.text.split(" ")[0]) for r in near_dedup.keep_one(table(rows)).collect())
    assert kept == Counter([(None, "w0"), (8, "W0"), (None, "alone"), (None, ""), (8, "")])


def near_by_hand(rows, least=0.8):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    own = {i: i for i in sets}

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                own[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in sets}


def test_near_groups_against_all_pairs(table):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(40, 150))]
        for _ in range(rng.choice([1, 2, 12])):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i, " ".join(t)))
            i += 1
    rows += [(i + k, " ".join(passage + [rng.choice(words) for _ in range(60)])) for k in range(30)]
    want = near_by_hand(rows)
    got = near_dedup.near_groups(table(rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)


def test_near_groups_link_equal_sets_of_repeated_passages(table):
    """Repeating a passage lowers the probability Jaccard to about 0.4 and leaves the sets alike."""
    rows = []
    for g in range(12):
        words = [f"g{g}w{k}" for k in range(200)]
        line = [f"g{g}l{k}" for k in range(20)]
        rows += [(10 * g, " ".join(line * 2 + words)), (10 * g + 1, " ".join(line * 20 + words))]
    want = near_by_hand(rows)
    assert all(want[10 * g + 1] == 10 * g for g in range(12))
    assert {r.doc_id: r.class_id for r in near_dedup.near_groups(table(rows)).collect()} == want


def test_near_groups_link_weighted_sets_of_unlike_sizes(table):
    """Nearly all weight lies on one repeated line: 20 and about 80 distinct shingles, probability Jaccard above 0.9."""
    line = [f"l{k}" for k in range(20)]
    rows = [(1, " ".join(line * 50)), (2, " ".join(line * 50 + [f"x{k}" for k in range(60)]))]
    (a, x), (b, y) = (near_dedup.shingles(t) for _, t in rows)
    assert len(a) < 0.64 * len(b) and near_dedup.probability_jaccard(a, x, b, y) >= 0.9
    assert {r.class_id for r in near_dedup.near_groups(table(rows)).collect()} == {1}


def test_near_groups_verify_pairs_that_share_one_band(table):
    """This pair, of similarity 0.8, shares one of the 48 bands."""
    words = [f"s1569w{k}" for k in range(49)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:44] + [f"s1569v{k}" for k in range(5)]))]
    frame = table(rows)
    signed = [set(r.bands) for r in near_dedup._signed(frame, "doc_id", "text", near_dedup.BANDS, near_dedup.ROWS).collect()]
    assert len(signed[0] & signed[1]) == 1
    assert {r.doc_id: r.class_id for r in near_dedup.near_groups(frame).collect()} == near_by_hand(rows) == {1: 1, 2: 1}


def test_near_groups_compares_whole_buckets(table):
    """One band of one row makes crowded buckets of unlike texts: leaders must reach every pair."""
    rng = random.Random(5)
    common = [f"c{k}" for k in range(40)]
    rows = []
    for g in range(25):
        own = [f"g{g}x{k}" for k in range(12)]
        for k in range(3):
            rows.append((100 * g + k, " ".join(common + own[: 12 - (k == 2)])))
    rng.shuffle(rows)
    assert {r.doc_id: r.class_id for r in near_dedup.near_groups(table(rows), least=0.95, bands=6, rows=1).collect()} == near_by_hand(rows, 0.95)


def crowd(seed: int, groups: int, common: int):
    """Texts that share most words but not enough, among them near copies that no leader of the whole bucket finds."""
    rng = random.Random(seed)
    head = [f"c{k}" for k in range(common)]
    rows = []
    for g in range(groups):
        own = [f"g{g}x{k}" for k in range(rng.randint(20, 60))]
        for k in range(rng.choice([1, 1, 2, 4])):
            text = head + own[: len(own) - rng.randint(0, 12)]
            if rng.random() < 0.3:
                text = text + [f"g{g}r{j}" for j in range(8)] * rng.randint(2, 4)
            rows.append((10 * g + k, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups_in_a_crowd_of_unlike_texts(table, seed):
    rows = crowd(seed, 60, 50)
    sets = {i: near_dedup.shingles(t) for i, t in rows}
    own = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        if near_dedup.jaccard(sets[a][0], sets[b][0]) >= 0.8 or near_dedup.probability_jaccard(*sets[a], *sets[b]) >= 0.8:
            old, new = max(own[a], own[b]), min(own[a], own[b])
            own = {i: new if r == old else r for i, r in own.items()}
    assert {r.doc_id: r.class_id for r in near_dedup.near_groups(table(rows), bands=60, rows=1).collect()} == own


def test_rare_shingles_meet_every_linked_pair_and_few_others(spark):
    """Sets with and without counts, of a pool with common and rare members; all pairs against those that share a key."""
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = []
    for g in range(30):
        base = np.concatenate([pool[:60], pool[60 + 10 * g : 60 + 10 * g + rng.integers(10, 40)]])
        for _ in range(4):
            h = np.sort(base[rng.random(len(base)) < rng.uniform(0.85, 1)])
            c = rng.integers(1, 9, len(h)) if rng.random() < 0.4 else np.ones(len(h), int)
            sets.append((h, c))
    rows = [(k, h.tobytes(), c.astype("<u4").tobytes() if (c > 1).any() else b"") for k, (h, c) in enumerate(sets)]
    frame = spark.createDataFrame(rows, "node long, h binary, c binary")
    rare = near_dedup._rare(frame, frame, 0.8)
    keys: dict[int, set[int]] = {}
    for r in rare.collect():
        keys.setdefault(r.node, set()).add(r.band)
        assert r.n == len(sets[r.node][0]) and r.repeats == (sets[r.node][1] > 1).any() and 0 <= r.rank < r.n
    pairs, _ = near_dedup._next(rare.withColumn("comp", F.col("node")), 1 << 40, 0.8)  # every holder is a leader
    met = {(r.a, r.b) for r in pairs.collect()}
    links, unlike = 0, 0
    for a, b in combinations(range(len(sets)), 2):
        (ha, ca), (hb, cb) = sets[a], sets[b]
        both = keys.get(a, set()) & keys.get(b, set())
        if near_dedup.jaccard(ha, hb) >= 0.8 or near_dedup.probability_jaccard(ha, ca, hb, cb) >= 0.8:
            links += 1
            assert both and (a, b) in met
        else:
            unlike += bool(both) and (a, b) not in met
    assert unlike > 100  # share a rare shingle, but are no pair
    assert links > 20


def test_near_groups_odd_rows(table):
    got = {(r.doc_id, r.class_id, r.class_size, r.kept) for r in near_dedup.near_groups(table(ODD)).collect()}
    assert got == {(1, 1, 1, True), (2, 2, 1, True), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 1, True), (6, 6, 2, True), (None, None, 1, True)}
    assert near_dedup.near_groups(table([])).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    assert {r.node: r.comp for r in near_dedup.components(edges).collect()} == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 150, dtype=np.uint64)
    a, b = np.sort(pool[:120]), np.sort(pool[30:])
    x, y = rng.integers(1, 6, 120), rng.integers(1, 6, 120)
    m = 4000
    s = near_dedup.probability_signatures(np.concatenate([a, b]), np.concatenate([x, y]).astype(float), np.repeat([0, 1], 120), 2, m)
    exact = near_dedup.probability_jaccard(a, x, b, y)
    both = np.union1d(a, b)
    wx, wy = dict(zip(a.tolist(), x.tolist())), dict(zip(b.tolist(), y.tolist()))
    slow = sum(1 / sum(max(wx.get(j, 0) / wx[i], wy.get(j, 0) / wy[i]) for j in both.tolist()) for i in both.tolist() if i in wx and i in wy)
    assert abs(exact - slow) < 1e-9 and abs((s[0] == s[1]).mean() - exact) < 0.04
    assert near_dedup.probability_jaccard(a, np.ones(120), b, np.ones(120)) == near_dedup.jaccard(a, b) or abs(near_dedup.probability_jaccard(a, np.ones(120), b, np.ones(120)) - near_dedup.jaccard(a, b)) < 1e-9


def test_texts_nobody_asked_for_are_not_shuffled(spark, table):
    docs = near_dedup.stage(table([(i, f"text {i} " + "of some words " * (i % 7 + 1)) for i in range(4000)]), "docs")
    contents = docs.select((F.col("doc_id") * 2).alias("node"), "doc_id", near_dedup._content(F.col("text")).alias("key"))
    nodes = near_dedup.stage(contents.where("doc_id % 100 = 7").select("node"), "nodes")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    store, first = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = near_dedup._node_shingles(docs, near_dedup.stage(contents, "contents"), nodes, "doc_id", "text").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    want = {2 * i: near_dedup.shingles(f"text {i} " + "of some words " * (i % 7 + 1))[0].tobytes() for i in range(7, 4000, 100)}
    assert {r.node: bytes(r.h) for r in found} == want and len(found) == 40
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    rows_out = []
    for job in range(first, spark.sparkContext._jsc.sc().dagScheduler().nextJobId()):
        stages = store.job(job).stageIds().iterator()
        while stages.hasNext():
            try:
                done = store.lastStageAttempt(stages.next())
            except Exception:  # a stage that was skipped
                continue
            rows_out.append(done.shuffleWriteRecords())
    # Their ids (once for the join that names them), never their texts.
    assert sum(n for n in rows_out if n >= 4000) <= 4000
