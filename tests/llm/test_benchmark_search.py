"""Hard negatives, lexical search and decontamination against plain loops."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from locuspark.llm import decontaminate, lexical, negatives
from locuspark.llm.words import word_places, words
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows_by_hand(items, length):
    out = {}
    for item, text in items:
        w = plain_words(text)
        m = min(length, len(w))
        for a in range(len(w) - m + 1 if w else 0):
            out.setdefault(tuple(w[a : a + m]), set()).add(item)
    return out


def leaks_by_hand(text, windows):
    w = plain_words(text)
    hit, items = set(), set()
    for m in {len(x) for x in windows}:
        for a in range(len(w) - m + 1):
            own = windows.get(tuple(w[a : a + m]))
            if own is not None:
                hit |= set(range(a, a + m))
                items |= own
    return len(w), len(hit), sorted(str(i) for i in items if i is not None)


def test_words_are_those_of_the_pattern():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(chr(rng.choice([*range(128), 0xC4, 0xE4, 0x130, 0x3000, 0x1F600, 0x85])) for _ in range(60))
        assert [w.decode() for w in words(text)] == plain_words(text)
        assert [text.encode()[a:b].lower() for a, b in word_places(text)] == words(text)


def test_automaton_knows_the_longest_sequence():
    """Few words, so that states split, stretches join and pieces are cut."""
    rng = random.Random(9)
    items = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 12))] for _ in range(12)]
    known = {tuple(i[a:b]) for i in items for a in range(len(i)) for b in range(a + 1, len(i) + 1)}
    found = decontaminate.suffix_automaton(items)
    text = [rng.choice([b"a", b"b", b"c", b"c", b"x"]) for _ in range(1500)] + [b"a", b"b"] * 700
    ids = np.array([found.vocabulary.get(w, -1) for w in text])
    _, lengths = found.longest(ids)
    want = [max((m for m in range(min(i + 1, 12) + 1) if tuple(text[i + 1 - m : i + 1]) in known), default=0) for i in range(len(text))]
    assert lengths.tolist() == want


def leak_case(seed):
    rng = random.Random(seed)
    vocabulary = ["ab", "Cd", "éf", "Éf", "g9", "hi", "JK"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9)))) for i in range(14)]
    items += [(14, items[0][1]), (3, "ab Cd ab"), (20, None), (21, " ,. "), (None, "hi hi JK g9")]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice([*vocabulary, "zz", "\n", "--"]) for _ in range(rng.randint(0, 40)))
        if i % 3 == 0:
            text += ", " + rng.choice(items[:14])[1].upper() + "! " + rng.choice(items[:14])[1]
        rows.append((i, text))
    return [*rows, *[(r[0], r[1]) for r in ODD], (7, rows[7][1]), (8, rows[9][1])], items


def test_passages_against_every_window(spark, table):
    for seed, length, block in ((1, 4, 10**9), (2, 3, 60), (3, 10, 10**9)):
        rows, items = leak_case(seed)
        frame = spark.createDataFrame(items, "item_id long, text string").withColumn("n_hit", F.lit(1))
        windows = windows_by_hand(items, length)
        got = decontaminate.find_passages(table(rows), frame, length, block_bytes=block).collect()
        have = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got)
        want = Counter()
        for i, text in rows:
            n, hit, own = leaks_by_hand(text, windows)
            want[(i, n, hit, tuple(own))] += 1
        assert have == want
        texts = {}
        for i, text in rows:
            texts.setdefault(i, []).append(text)
        for r in got:
            if len(texts[r.doc_id]) == 1 and r.n_hit:
                text = texts[r.doc_id][0]
                assert sum(len(plain_words(text[s.start : s.end])) for s in r.spans) == r.n_hit
                assert all(a.end <= b.start for a, b in zip(r.spans, r.spans[1:]))


def test_decontaminated_texts(spark, table):
    items = spark.createDataFrame([(1, "one two three four"), (2, "five six")], "item_id long, text string")
    rows = [(1, "keep this: One, two; three four. And ünd this"), (2, "five six"), (3, None), (4, "clean text"), (None, "x five six y z w v"), (5, "five six a b c five SIX d e f g h i"), (6, "")]
    for block in (10**9, 10):
        got = decontaminate.decontaminated(table(rows), items, length=3, coverage=0.5, block_bytes=block)
        assert got.columns == table(rows).columns
        assert {(r.doc_id, r.text) for r in got.collect()} == {
            (1, "keep this: . And ünd this"), (3, None), (4, "clean text"), (None, "x  y z w v"), (5, " a b c  d e f g h i"), (6, ""),
        }
    assert decontaminate.find_passages(table([]), items).count() == 0
    none = decontaminate.find_passages(table(rows), items.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.n_hit or r["items"] or r.longest for r in none)


def ranking_by_hand(rows, items, k):
    docs = [(i, Counter(w), len(w)) for i, text in rows if (w := plain_words(text))]
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = 0
            for t in set(plain_words(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def test_ranking_against_all_scores(spark, table):
    rng = random.Random(5)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)] + ["Über", "THE"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 20, 20, 200])))) for i in range(400)]
    rows += [(400 + i, rows[i % 5][1]) for i in range(40)] + [(5, rows[6][1])] + [(r[0], r[1]) for r in ODD]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12)))) for i in range(12)]
    items += [(50, "unseen words only"), (51, None), (52, ""), (53, "word text"), (None, "one über")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1))
    want = ranking_by_hand(rows, items, 50)
    for block, postings in ((10**9, 10**6), (80, 700)):
        found = lexical.search(table(rows).repartition(3), frame, 50, block_bytes=block, shard_postings=postings)
        assert Counter(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect())) == want
    again = lexical.search(table(rows), frame.unionByName(frame), 3)
    assert Counter(map(tuple, again.collect())) == ranking_by_hand(rows, items, 3)
    assert lexical.search(table([]), frame).count() == 0 and lexical.search(table(rows), frame.limit(0)).count() == 0


def test_shards_read_on_until_bounds_meet():
    """Long lists of like impacts with ties at the limit, beyond the first read."""
    rng = np.random.default_rng(2)
    size, terms = 3000, 6
    doc, impact, ends = [], [], []
    whole = np.zeros(size, np.int64)
    for t in range(terms):
        some = rng.permutation(size)[: rng.integers(200, size)]
        gain = np.sort(rng.integers(1, 8, len(some)))[::-1]
        doc.append(some), impact.append(gain)
        ends.append(sum(map(len, doc)))
        whole[some] += gain
    shard = lexical.Shard(size, np.concatenate(doc).astype("<i4"), np.concatenate(impact), np.array(ends))
    kth = np.sort(whole)[-50]
    for limit in (0, int(kth), int(kth) + 3):
        docs, score = shard.search(np.arange(terms), 50, limit)
        floor = max(int(kth), limit)
        assert dict(zip(docs.tolist(), score.tolist())) == {i: int(s) for i, s in enumerate(whole) if s >= floor}
    assert (shard.first_bounds(np.arange(terms), 50) <= np.sort(whole)[::-1][:50]).all()


def negatives_by_hand(rows, wide, positives=5, negatives_=10):
    good = [(i, lab, np.pad(np.floor(np.array(v, float) * 256), (0, wide - len(v))).astype(int)) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asking = {}
    for i, lab, v in good:
        if i % 10 == 0:
            asking[i] = min(asking.get(i, (lab, v.tolist())), (lab, v.tolist()))
    out = Counter()
    for a, (lab, v) in asking.items():
        scored = [(i, own, int(np.dot(v, w))) for i, own, w in good if i != a]
        first = sorted((-s, i) for i, own, s in scored if own == lab)[:positives]
        for p, i in first:
            window = sorted((-s, j) for j, own, s in scored if own != lab and 30 * -p <= 100 * s <= 90 * -p)[:negatives_]
            out.update((a, i, r + 1, j, -p, -s) for r, (s, j) in enumerate(window))
    return out


def test_negatives_against_all_products(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.choice([0, 0, 0, 1, 2])), (np.round(rng.normal(size=6) * 2) / 2 * rng.choice([0.2, 1, 2])).tolist()) for i in range(500)]
    rows += [(500 + i, i % 3, rows[i][2]) for i in range(60)]  # ties
    rows += [(800, 0, None), (810, None, [1.0]), (820, 0, [1.0, None]), (830, 1, [float("nan")]), (840, 2, []), (850, 7, [3.0, 1.0]), (None, 0, [1.0]), (10, 1, rows[3][2]), (11, 0, rows[4][2]), (11, 0, rows[4][2]), (860, 2, [0.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("rank", F.lit(0)).withColumn("score", F.lit("x"))
    want = negatives_by_hand(rows, 6)
    assert len(want) > 1000
    for block, anchors in ((8192, 1024), (40, 7)):
        found = negatives.mine(frame, F.col("vec_id") % 10 == 0, F.col("label"), block=block, anchor_block=anchors)
        assert Counter(map(tuple, found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())) == want
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert negatives.mine(frame.limit(0), F.col("vec_id") % 10 == 0, F.col("label")).count() == 0
    assert negatives.mine(frame.where("label = 7"), F.col("vec_id") % 10 == 0, F.col("label")).count() == 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_threshold_stops_early_and_loses_nothing():
    """Skewed components: most rows are never met, ties at the k-th score are."""
    rng = np.random.default_rng(1)
    values = rng.integers(-3, 4, (4000, 4))
    values[:30] += 40
    orders = np.argsort(values, axis=0, kind="stable").T.astype("<u2")
    block = negatives.Block({"ids": np.arange(4000, dtype="<i8").tobytes(), "values": values.astype("<i8").tobytes(), "n": 4000, "dims": 4, "orders": orders.tobytes()})
    for anchor in (np.array([1, 2, 1, 3]), np.array([-1, 0, 2, 0]), np.zeros(4, int)):
        best = negatives.Best(10, -(2**62), 2**62)
        met = block.read(anchor, 5, [best])
        assert met < 500 or not anchor.all()
        score = values @ anchor
        want = sorted((-int(s), i) for i, s in enumerate(score) if i != 5)[:10]
        assert list(zip((-best.scores).tolist(), best.ids.tolist())) == want
