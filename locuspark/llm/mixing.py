"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns.

Documents are summed up by the set of sources they belong to. Tokens flow from
each pattern to its sources: the first use of a pattern's tokens is cheap, each
repetition costs more (convex), a source takes its target at most. The graph has
a node per pattern and per source, whatever the number of documents. The flow
says how many words each pattern gives: so many whole passes, and a rest.

The rest is chosen among the pattern's documents in the order of a seeded hash.
The place where the order is cut is found by refining hash ranges over sums (a
radix search), so no pattern is ever gathered or sorted in one task; only the
last range, of about ``CELL`` documents, is filled one by one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locuspark.llm.common import small_table, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Costs of the first, second and third use of a document.
COSTS = (1, 3, 6)
#: Documents of the hash range that is filled one by one, and hash bits a step refines.
CELL, BITS, KEY_BITS = 256, 4, 60
#: Distinct membership patterns the driver accepts in the flow graph.
PATTERNS = 100_000
STATE = (
    "pattern string, full long, rest long, docs long, lo long, hi long, "
    "sources array<struct<source: string, size: long, target: double>>"
)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def cyclic_weights(sources: Sequence[str | None], cycle: Sequence[int] = (1, 2, 3)) -> dict[str | None, int]:
    """1, 2, 3, 1, ... over sources by code point, null last."""
    ordered = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: cycle[k % len(cycle)] for k, s in enumerate(ordered)}


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, int], total: int, limit: int = 3) -> dict[str | None, Fraction]:
    """Shares of ``total`` by weight; none above ``limit`` times its size, the excess shared again."""
    found: dict[str | None, Fraction] = {}
    open_, left = {s for s in sizes if weights[s] > 0}, Fraction(total)
    found.update({s: Fraction(0) for s in sizes if s not in open_})
    while open_:
        share = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if share * weights[s] > limit * sizes[s]}
        for s in over or open_:
            found[s] = Fraction(limit * sizes[s]) if over else share * weights[s]
            left -= found[s]
        open_ = open_ - over if over else set()
    return found


def min_cost_flow(words: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], costs: Sequence[int] = COSTS) -> list[int]:
    """Words that each pattern gives; ``members`` are the sources of each pattern, by number.

    Successive cheapest paths, each found by Bellman-Ford over few nodes. The
    flow is as large as the quotas and the repetitions allow.
    """
    n_p, n_s = len(words), len(quotas)
    start, end = n_p + n_s, n_p + n_s + 1
    edges: list[list[int]] = []  # to, capacity, cost; the reverse edge follows each
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def edge(a: int, b: int, capacity: int, cost: int) -> None:
        out[a].append(len(edges))
        edges.append([b, capacity, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])

    for p, size in enumerate(words):
        for cost in costs:
            edge(start, p, size, cost)
        for s in members[p]:
            edge(p, n_p + s, len(costs) * size, 0)
    for s, quota in enumerate(quotas):
        edge(n_p + s, end, quota, 0)
    while True:
        far = {start: 0}
        via: dict[int, int] = {}
        queue, queued = [start], {start}
        while queue:
            a = queue.pop(0)
            queued.discard(a)
            for e in out[a]:
                b, capacity, cost = edges[e]
                if capacity > 0 and far[a] + cost < far.get(b, 1 << 60):
                    far[b], via[b] = far[a] + cost, e
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if end not in far:
            break
        path, b = [], end
        while b != start:
            path.append(via[b])
            b = edges[via[b] ^ 1][0]
        amount = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= amount
            edges[e ^ 1][1] += amount
    return [sum(edges[e ^ 1][1] for e in out[start] if edges[e][0] == p) for p in range(n_p)]


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Choose documents of one hash range in order, each that still fits; then mend the rest."""
    pdf = pdf.sort_values(["key", "doc_id", "size"], kind="stable")
    rest = int(pdf["rest"].iloc[0])
    words = (pdf["size"] * pdf["n"]).to_numpy(np.int64)
    taken = np.zeros(len(pdf), np.int32)
    for k, w in enumerate(words.tolist()):
        if w <= rest:
            taken[k], rest = 1, rest - w
    # What is missing now: one more document, or one exchanged for another, if that is nearer.
    out, in_ = np.flatnonzero(taken == 0), np.flatnonzero(taken == 1)
    if len(out):
        gain = words[out][None] - np.append(words[in_], 0)[:, None]
        best = np.argmin(np.abs(rest - gain))
        if abs(rest - gain.ravel()[best]) < rest:
            leaves, comes = divmod(int(best), len(out))
            taken[out[comes]] = 1
            if leaves < len(in_):
                taken[in_[leaves]] = 0
    return pdf.assign(extra=taken)[["pattern", "key", "doc_id", "size", "extra"]]


def _refine(narrow: DataFrame, state: DataFrame, bits: int) -> DataFrame:
    """Narrow each hash range that holds too many documents to the 1/16 of it where the rest runs out."""
    open_ = (F.col("rest") > 0) & (F.col("docs") > CELL)
    inside = narrow.join(state.where(open_), "pattern").where((F.col("key") >= F.col("lo")) & (F.col("key") < F.col("hi")))
    digit = F.shiftright(F.col("key") - F.col("lo"), bits).alias("digit")
    kept = ["pattern", "full", "rest", "lo", "sources"]
    sums = inside.groupBy(*kept, digit).agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.count(F.lit(1)).alias("found"))
    before = Window.partitionBy("pattern").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    cut = sums.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
    lo = F.col("lo") + F.col("digit") * F.lit(1 << bits)
    moved = cut.select("pattern", "full", (F.col("rest") - F.col("before")).alias("rest"), F.col("found").alias("docs"), lo.alias("lo"), (lo + (1 << bits)).alias("hi"), "sources")
    return state.where(~open_).unionByName(moved)


def mix(
    docs: DataFrame,
    sources: Column,
    weights: Mapping[str | None, int] | None = None,
    limit: int = 3,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every column of ``docs``, its sources, its words and how often it is taken.

    ``sources`` is an array of strings for each document; the sources of a
    document share its words. New columns: mix_sources (name, size and target of
    each source), mix_size, mix_copies; they replace columns of ``docs`` with these
    names, all others keep theirs, whatever they are called.
    A null text has no words. Rows with the same id, size and sources are taken
    together or not at all; a document whose array is null or empty is never taken.
    Weights default to 1, 2, 3, repeating. Without words nothing is taken; an empty
    table gives an empty result.
    """
    new = ("mix_sources", "mix_size", "mix_copies")
    own = [c for c in docs.columns if c.lower() not in new]
    return _mix(docs, sources, weights, limit, seed, id_col, text_col).select(*[F.col("row").getField(c).alias(c) for c in own], *new)


def _mix(docs: DataFrame, sources: Column, weights: Mapping[str | None, int] | None, limit: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """row (all columns of a document), mix_sources, mix_size, mix_copies."""
    spark = docs.sparkSession
    size = word_count(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), docs[id_col].cast("string")), 64 - KEY_BITS)
    named = F.coalesce(sources, F.array().cast("array<string>"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = docs.select(row, F.to_json(named).alias("mix_pattern"), size.alias("mix_size"), key.alias("mix_key"), docs[id_col].cast("string").alias("mix_doc_id"))
    narrow = stage(
        marked.groupBy("mix_pattern", F.col("mix_key").alias("key"), F.col("mix_doc_id").alias("doc_id"), F.col("mix_size").alias("size"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumnRenamed("mix_pattern", "pattern"),
        "mix-documents",
    )
    sums = narrow.groupBy("pattern").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.count(F.lit(1)).alias("docs"))
    found = sums.withColumn("sources", F.from_json("pattern", "array<string>")).orderBy("pattern").limit(PATTERNS + 1).collect()
    if len(found) > PATTERNS:
        raise ValueError(f"more than {PATTERNS} membership patterns: name fewer sources")
    sizes: dict[str | None, int] = {}
    for r in found:
        for s in dict.fromkeys(r.sources or []):
            sizes[s] = sizes.get(s, 0) + r.words
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = targets(sizes, weights or cyclic_weights(names), sum(r.words for r in found), limit)
    number = {s: k for k, s in enumerate(names)}
    given = min_cost_flow(
        [r.words for r in found], [[number[s] for s in dict.fromkeys(r.sources or [])] for r in found],
        [round(goal[s]) for s in names], COSTS[:limit] if limit <= len(COSTS) else [k * (k + 1) // 2 for k in range(1, limit + 1)],
    )
    rows = [
        (r.pattern, words // max(r.words, 1), words % max(r.words, 1), r.docs, 0, 1 << KEY_BITS, [(s, sizes[s], float(goal[s])) for s in dict.fromkeys(r.sources or [])])
        for r, words in zip(found, given)
    ]
    state = stage(small_table(spark, rows, STATE), "mix-state")
    for bits in range(KEY_BITS - BITS, -1, -BITS):
        if state.where((F.col("rest") > 0) & (F.col("docs") > CELL)).isEmpty():
            break
        state = stage(_refine(narrow, state, bits), "mix-state")
    cell = narrow.join(state.where("rest > 0").select("pattern", "lo", "hi", "rest"), "pattern")
    cell = cell.where((F.col("key") >= F.col("lo")) & (F.col("key") < F.col("hi")))
    chosen = stage(cell.groupBy("pattern").applyInPandas(_fill, "pattern string, key long, doc_id string, size long, extra int"), "mix-chosen")
    names_of = {c: f"mix_{c}" for c in ("pattern", "key", "size", "doc_id")}
    chosen = chosen.withColumnsRenamed(names_of)
    placed = marked.join(state.withColumnRenamed("pattern", "mix_pattern"), "mix_pattern")
    same = [marked_c.eqNullSafe(chosen[c]) if c == "mix_doc_id" else marked_c == chosen[c] for c, marked_c in ((c, placed[c]) for c in names_of.values())]
    joined = placed.join(chosen, same, "left")
    extra = F.when(placed["mix_key"] < placed["lo"], 1).otherwise(F.coalesce(chosen["extra"], F.lit(0)))
    return joined.select(
        placed["row"],
        placed["sources"].alias("mix_sources"),
        placed["mix_size"],
        (placed["full"] + extra).cast("int").alias("mix_copies"),
    )


def mixed(
    docs: DataFrame,
    source_col: str = "source",
    weights: Mapping[str | None, int] | None = None,
    limit: int = 3,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents of a mix of single sources: each row as often as it is taken, with the columns of ``docs`` as they are."""
    taken = _mix(docs, F.array(F.col(source_col).cast("string")), weights, limit, seed, id_col, text_col).where("mix_copies > 0")
    copies = taken.select("row", F.explode(F.sequence(F.lit(1), "mix_copies")))
    return copies.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
