"""Near-duplicate groups: ProbMinHash signatures of weighted shingles, banding, exact verification.

1. Texts with the same word sequence are one content; each content is a node.
2. A shingle is five consecutive words; its weight is how often it occurs. Each
   shingle is a Poisson process whose rate is its weight: arrivals come at
   exponential distances, each for a random component of the signature, and the
   earliest shingle of a component stays. A process stops as soon as its next
   arrival is later than every component's earliest. Two signatures agree in a
   component with the probability Jaccard similarity of the weighted sets. A
   text that repeats a shingle has a second signature, of weights 1, which
   agrees with the Jaccard similarity of the sets; both are banded.
3. Bands of components are bucket keys. In each bucket the members are first
   compared with one leader: groups of copies of any size cost one comparison per
   member. Members of buckets that are not connected then meet at their rarest
   shingles, see ``_rare``: two contents that reach the similarity always share one,
   while contents with enough shingles of their own meet nobody, however crowded
   their bucket. Where several meet they are again compared with leaders, more and
   more at once, until every pair was compared or is connected anyway. So no link
   between contents that share a bucket is lost.
4. Compared pairs are verified on their shingles. Links are joined to components
   by star contraction. All of this is tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.llm.common import arrow_batches, mix64, slices, stage, text_of
from locuspark.llm.exact_dedup import _repeated, normalised, one_copy
from locuspark.session import settings

WORDS, SIMILARITY = 5, 0.8
#: At similarity 0.8 a pair agrees in 10 bands on average, in none with probability 1.2e-5.
#: Every pair that agrees in one is verified, unless its sizes rule a link out.
BANDS, ROWS = 48, 7
#: The filter pays for texts of any size, and its own side may be large: of that only bits are gathered.
_FILTERED = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64g",
}
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def probability_signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n x m) of n weighted sets; row k of the inputs is an element of set ``owner[k]``.

    Arrivals of an element depend on its hash alone. The first arrivals are drawn
    together, about as many as a set needs to fill its components; after them,
    only processes that can still be earliest go on.
    """
    best = np.full(n * m, np.inf)
    who = np.zeros(n * m, np.uint64)
    size = np.maximum(np.bincount(owner, minlength=n), 1)
    burst = np.maximum(1, np.ceil(m * np.log(m) / size)).astype(np.int64)[owner]

    def offer(e: np.ndarray, t: np.ndarray, o: np.ndarray, turn: np.ndarray) -> None:
        slot = o * m + (mix64((e ^ _GOLDEN) + turn * _ODD[0]) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, slot, t)
        won = best[slot] == t
        who[slot[won]] = e[won]

    def waits(e: np.ndarray, turn: np.ndarray, w: np.ndarray) -> np.ndarray:
        u = ((mix64(e + turn * _GOLDEN) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        return -np.log(u) / w

    t = np.zeros(len(elements))
    for turns in np.unique(burst).tolist():  # sets of like size together
        rows = np.flatnonzero(burst == turns)
        e = np.repeat(elements[rows], turns).reshape(-1, turns)
        turn = np.broadcast_to(np.arange(1, turns + 1, dtype=np.uint64), e.shape)
        times = np.cumsum(waits(e, turn, weights[rows][:, None]), axis=1)
        offer(e.ravel(), times.ravel(), np.repeat(owner[rows], turns), turn.ravel())
        t[rows] = times[:, -1]
    rows = np.arange(len(elements))
    turn = burst.astype(np.uint64)
    while True:
        open_sets = np.unique(owner[rows])
        latest = np.full(n, -1.0)
        latest[open_sets] = best.reshape(n, m)[open_sets].max(axis=1)
        rows = rows[t[rows] < latest[owner[rows]]]
        if not len(rows):
            return who.reshape(n, m)
        turn[rows] += np.uint64(1)
        t[rows] += waits(elements[rows], turn[rows], weights[rows])
        early = rows[t[rows] < latest[owner[rows]]]
        offer(elements[early], t[early], owner[early], turn[early])
        rows = early


class _Words:
    """64-bit hashes of words; a bounded memory per worker."""

    def __init__(self, most: int = 50_000) -> None:
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        known = self.known
        if len(known) > self.most:
            known.clear()
        got = list(map(known.get, words))
        if None in got:
            for k, h in enumerate(got):
                if h is None:
                    got[k] = known[words[k]] = xxh3_64_intdigest(words[k])
        return np.array(got, np.uint64)


_HASHES = _Words()


def shingles(text: str, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles in ascending order, and how often each occurs.

    A text of fewer words than ``width`` is one shingle; one without words has none.
    """
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = _HASHES(words)
    k = min(width, len(h))
    n = len(h) - k + 1
    mixed = np.full(n, np.uint64(k))
    for j in range(k):
        mixed += mix64(h[j : j + n] ^ _ODD[j % 5]) * _ODD[(j + 1) % 5] + np.uint64(j)
    return np.unique(mix64(mixed), return_counts=True)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key per band, over its components and its number."""
    parts = signatures.reshape(len(signatures), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(rows):
        keys = mix64(keys * _GOLDEN + parts[:, :, j])
    return keys


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(len(a) + len(b) - common, 1)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Sum over common elements i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    both = np.union1d(a, b)
    wx, wy = np.zeros(len(both)), np.zeros(len(both))
    wx[np.searchsorted(both, a)], wy[np.searchsorted(both, b)] = x, y
    with np.errstate(divide="ignore"):
        ratio = np.where(wy > 0, wx / np.maximum(wy, 1e-300), np.inf)
    order = np.argsort(ratio, kind="stable")
    sx, sy, r = np.cumsum(wx[order]), np.cumsum(wy[order]), ratio[order]
    common = np.flatnonzero((wx[order] > 0) & (wy[order] > 0))
    upto = np.searchsorted(r, r[common], "left")  # those before have a smaller ratio: y decides
    below_x, below_y = np.where(upto > 0, sx[upto - 1], 0), np.where(upto > 0, sy[upto - 1], 0)
    return float((1 / ((sx[-1] - below_x) / wx[order][common] + below_y / wy[order][common])).sum()) if len(common) else 0.0


def _signed(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """doc_id, key (content), n (shingles), repeats (whether one occurs twice), bands; the key is null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(h) for h, _ in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            found = probability_signatures(np.concatenate([h for h, _ in sets]), np.concatenate([c for _, c in sets]).astype(float), owner, len(sets), bands * rows)
            keys = list(band_keys(found, bands, rows).view(np.int64))
            # Sets with repeated shingles meet others by their set, too; for the rest both signatures are the same.
            again = [k for k, (_, c) in enumerate(sets) if (c > 1).any()]
            if again:
                once = np.concatenate([sets[k][0] for k in again])
                found = probability_signatures(once, np.ones(len(once)), np.repeat(np.arange(len(again)), sizes[again]), len(again), bands * rows)
                for k, more in zip(again, band_keys(found, bands, rows).view(np.int64)):
                    keys[k] = np.union1d(keys[k], more)
            keys = pa.array(keys, pa.list_(pa.int64()))
            repeats = np.zeros(len(sets), bool)
            repeats[again] = True
            new = [pa.array(sizes, pa.int64()), pa.array(repeats), keys]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *new], names=["doc_id", "key", "n", "repeats", "bands"])

    texts = arrow_batches(_keyed(docs, id_col, text_col))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, key binary, n long, repeats boolean, bands array<long>")


def _content(text: Column) -> Column:
    """128-bit hash of the word sequence; null for texts without words."""
    words = F.trim(normalised(text))
    return F.when(words != "", F.unhex(F.md5(words.cast("binary"))))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return text_of(docs, id_col, text_col).select("doc_id", _content(F.col("text")).alias("key"), "text")


def _node_shingles(docs: DataFrame, contents: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, h, c: the shingles of every node in ``nodes``, read from one document of its content.

    c are the counts; it is empty where every shingle occurs once.
    Texts are read once for all rounds, and only those of these documents are looked at.
    A Bloom filter of their ids (Spark's, bounded by its settings) goes over the texts
    before the join, so that a shuffle carries few others.
    """
    wanted = stage(contents.select("node", "key", F.col("doc_id").alias("of")).join(nodes, "node"), "near-wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            h = pa.array([x.tobytes() for x, _ in sets], pa.binary())
            c = pa.array([x.astype("<u4").tobytes() if (x > 1).any() else b"" for _, x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), h, c], names=["node", "h", "c"])

    # Spark builds the filter for a side that a comparison has narrowed; this one holds for every node.
    known, unknown = wanted.where("of is not null and node >= 0"), wanted.where("of is null")
    texts = text_of(docs, id_col, text_col)
    found = texts.join(known, F.col("doc_id") == F.col("of")).select("node", "key", "text")
    lost = texts.where("doc_id is null").withColumn("own", _content(F.col("text"))).join(unknown, F.col("own") == F.col("key")).select("node", "key", "text")
    found = found.unionByName(lost).where(_content(F.col("text")) == F.col("key"))
    found = arrow_batches(found.select("node", "text")).mapInArrow(run, "node long, h binary, c binary")
    with settings(docs.sparkSession, _FILTERED):
        return stage(found.dropDuplicates(["node"]), "near-shingles")


def _possible(contents: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """Pairs whose sizes allow a link."""
    a = contents.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("repeats").alias("a_repeats"))
    b = contents.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("repeats").alias("b_repeats"))
    alike = _alike(F.col("a_n"), F.col("b_n"), F.col("a_repeats") | F.col("b_repeats"), least)
    return pairs.join(a, "a").join(b, "b").where(alike).select("a", "b")


def _counts(c: bytes, n: int) -> np.ndarray:
    return np.frombuffer(c, "<u4") if c else np.ones(n, np.uint32)


def _links(sets: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """The pairs whose similarity is ``least`` or more: of their sets, or of their weighted sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for ah, ac, bh, bc in zip(*[batch.column(c).to_pylist() for c in ("ah", "ac", "bh", "bc")]):
                a, b = np.frombuffer(ah, np.uint64), np.frombuffer(bh, np.uint64)
                weighted = bool(ac or bc)  # else both similarities are the same
                kept.append(jaccard(a, b) >= least or (weighted and probability_jaccard(a, _counts(ac, len(a)), b, _counts(bc, len(b))) >= least))
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    # Only the sets of these pairs are moved; in later rounds they are a small part of all.
    pairs = stage(pairs, "near-compared")
    few = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stage(sets.join(stage(few, "near-few"), "node", "left_semi"), "near-sets")
    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("h").alias("ah"), F.col("c").alias("ac")), "a")
    with_b = with_a.join(sets.select(F.col("node").alias("b"), F.col("h").alias("bh"), F.col("c").alias("bc")), "b")
    return stage(arrow_batches(with_b).mapInArrow(run, "a long, b long"), "near-links")


def _rare(sets: DataFrame, open_: DataFrame, least: float) -> DataFrame:
    """node, n, repeats, band, rank, light: the rarest shingles of every node of ``open_``, as keys where nodes meet.

    Shingles are ordered by the number of these nodes that hold them. Of two sets
    of similarity t, the shared shingles are t of either set; probability Jaccard t
    means that they have t of either's weight. So the first shared one in that order
    comes before the rest of that share, in both, and no linked pair is lost. ``rank``
    is how many shingles of the node come before, ``light`` says that by their weight
    the key is among the first. Shingles of one node alone come first and need no
    key. The order is taken within one content at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "h", 2_000_000):
            h = [np.frombuffer(x, np.int64) for x in batch.column("h").to_pylist()]
            c = [_counts(x, len(own)) for x, own in zip(batch.column("c").to_pylist(), h)]
            sizes = np.array([len(x) for x in h])
            weight = np.repeat(np.array([x.sum() for x in c], np.int64), sizes)
            node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), sizes)
            columns = [node, np.concatenate(h), np.concatenate(c).astype(np.int64), np.repeat(sizes, sizes), weight]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["node", "band", "c", "n", "weight"])

    nodes = stage(open_.select("node").distinct(), "near-open")
    spelt = stage(arrow_batches(sets.join(nodes, "node", "left_semi")).mapInArrow(run, "node long, band long, c long, n long, weight long"), "near-spelt")
    often = spelt.groupBy("band").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    own = Window.partitionBy("node")
    before = own.orderBy("holders", "band").rowsBetween(Window.unboundedPreceding, -1)
    placed = spelt.join(often, "band").select(
        "*",
        (F.col("n") - F.count(F.lit(1)).over(own) + F.count(F.lit(1)).over(before)).alias("rank"),
        (F.col("weight") - F.sum("c").over(own) + F.coalesce(F.sum("c").over(before), F.lit(0))).alias("lighter"),
    )
    by_set, by_weight = (F.col(x) <= F.col(whole) * (1 - least + 1e-9) for x, whole in (("rank", "n"), ("lighter", "weight")))
    return placed.where(by_set | by_weight).select("node", "n", (F.col("weight") > F.col("n")).alias("repeats"), "band", "rank", by_weight.alias("light"))


def components(edges: DataFrame) -> DataFrame:
    """node, comp for every node of edges (a, b); comp is the smallest node it is connected with.

    Large-star and small-star steps alternate until nothing changes. Neighbours
    are never gathered: a step is a minimum per node, written, and a join.
    """
    edges = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stage(large.where("a != b").distinct(), "near-large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        new = stage(small.where("a != b").distinct(), "near-edges")
        # A forest of stars: nobody has two smaller neighbours, and no centre has one.
        centres = new.select(F.col("b").alias("a")).distinct()
        settled = new.groupBy("a").count().where("count > 1").isEmpty() and new.join(centres, "a", "left_semi").isEmpty()
        edges = new
        if settled:
            own = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
            return stage(edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(own), "near-components")


def _alike(n_a: Column, n_b: Column, repeats: Column, least: float) -> Column:
    """Whether two sets can reach the similarity by their sizes.

    Sizes bound only the similarity of sets, which is that of the weighted sets
    as well if neither repeats a shingle. Other pairs all go to verification.
    """
    return repeats | (F.least(n_a, n_b) >= F.greatest(n_a, n_b) * (least - 1e-9))


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """doc_id, class_id, class_size, kept for every row of ``docs``.

    Documents connected by similarities of ``least`` or more are one class, named
    by its smallest id, whose document is kept. Texts without words (null, empty)
    are alone. Rows with the same id count as copies of each other; null ids come
    last. Other columns are ignored; an empty table gives an empty result. Of a
    class whose smallest id has several texts, only rows of one text are kept.
    """
    return _grouped(docs, id_col, text_col, least, bands, rows).drop("key")


def _grouped(docs: DataFrame, id_col: str, text_col: str, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``near_groups`` with the content key of every row; it is null for texts without words."""
    signed = stage(_signed(docs, id_col, text_col, bands, rows), "near-signed")
    contents = signed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("repeats").alias("repeats"), F.first("bands").alias("bands"))
    contents = stage(contents.withColumn("node", F.monotonically_increasing_id()), "near-contents")
    member = contents.select("node", F.explode("bands").alias("band"))
    buckets = member.groupBy("band").agg(F.min("node").alias("lead"), F.max("node").alias("last"), F.count(F.lit(1)).alias("size"))
    buckets = stage(buckets.where("size > 1"), "near-buckets")
    crowded = buckets.where("size > 2").select("band", "lead")
    open_ = stage(member.join(crowded, "band").where("node != lead"), "near-members")
    two = buckets.where("size = 2").select(F.col("lead").alias("x"), F.col("last").alias("y"))
    found = stage(_ordered(two.unionByName(open_.select(F.col("lead").alias("x"), F.col("node").alias("y")))), "near-pairs")
    sets = _node_shingles(docs, contents, found.select(F.explode(F.array("a", "b")).alias("node")).distinct(), id_col, text_col)
    links = _links(sets, _possible(contents, found, least), least)
    forest = components(links)
    open_ = stage(_unsettled(open_.select("node", "band"), forest), "near-members")
    open_ = stage(_unsettled(stage(_rare(sets, open_, least), "near-rare"), forest), "near-members")
    leaders = 1
    while not open_.isEmpty():
        leaders *= 8
        pairs, open_ = _next(open_, leaders, least)
        links = _links(sets, pairs, least)
        if not links.isEmpty():
            forest = components(links.unionByName(forest.select(F.col("node").alias("a"), F.col("comp").alias("b"))))
        open_ = stage(_unsettled(open_, forest), "near-members")
    return _classes(signed, contents, forest)


def _ordered(found: DataFrame) -> DataFrame:
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _unsettled(open_: DataFrame, forest: DataFrame) -> DataFrame:
    """Members, with their components, of buckets that hold more than one component."""
    placed = open_.drop("comp").join(forest, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = placed.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("band")
    return placed.join(mixed, "band")


def _next(open_: DataFrame, leaders: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Possible pairs of up to ``leaders`` holders of each rare shingle with the others of other components, and who is left.

    At their first shared shingle, two sets share at most what either has from there
    on; similarity t takes t / (1 + t) of both sizes together. Where a text repeats
    shingles, the weights may link as well, if the key is among the first of both.
    Meetings that allow neither are no pairs; a link has one that does.
    """
    names = ("node", "n", "repeats", "comp", "rank", "light")
    part = F.pmod(F.xxhash64("node"), F.lit(leaders))
    lead = open_.groupBy("band", part.alias("part")).agg(F.min(F.struct(*names)).alias("lead"))
    lead = stage(lead.select(F.col("band").alias("l_band"), "lead.*").withColumnsRenamed({c: f"l_{c}" for c in names}), "near-leaders")
    meet = (F.col("band") == F.col("l_band")) & (F.col("comp") != F.col("l_comp"))
    repeats = F.col("repeats") | F.col("l_repeats")
    shared = F.least(F.col("n") - F.col("rank"), F.col("l_n") - F.col("l_rank"))
    by_set = shared >= (F.col("n") + F.col("l_n")) * (least / (1 + least) - 1e-9)
    joined = open_.join(lead, meet & (by_set | (repeats & F.col("light") & F.col("l_light"))))
    pairs = _ordered(joined.select(F.col("node").alias("x"), F.col("l_node").alias("y")))
    rest = open_.join(lead, (F.col("band") == F.col("l_band")) & (F.col("node") == F.col("l_node")), "left_anti")
    return pairs, stage(rest, "near-members")


def _classes(signed: DataFrame, contents: DataFrame, forest: DataFrame) -> DataFrame:
    named = contents.select("key", "node").join(forest, "node", "left").select("key", F.coalesce("comp", "node").alias("comp"))
    docs = signed.select("doc_id", "key").where("key is not null").join(named, "key").select("doc_id", "key", "comp")
    docs = stage(docs, "near-docs")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    sizes = docs.groupBy("comp").agg(first, F.count(F.lit(1)).alias("class_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    grouped = docs.join(sizes, "comp").select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size", kept.alias("kept"), "key")
    alone = signed.where("key is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"), "key")
    return grouped.unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` kept by ``near_groups``, with all their columns; of rows with the same id and words, one.

    Texts without words have no copies and all stay.
    """
    kept = _grouped(docs, id_col, text_col).where("kept and key is not null")
    kept = stage(kept.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key")).distinct(), "near-kept")
    own = _content(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    found = docs.join(kept, docs[id_col].eqNullSafe(kept["kept_id"]) & (own == kept["kept_key"]), "left_semi")
    if _repeated(docs, id_col):
        found = one_copy(found, id_col, text_col, _content(F.col(text_col).cast("string")))
    return found.unionByName(docs.where(own.isNull()))
