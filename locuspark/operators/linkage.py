"""Linkage between markers: independent tests, pairwise r-squared, pruning.

Genotypes are packed to one row per marker (an array over the strains, whose
number is bounded by the panel); matrix work happens on bounded blocks of such
rows inside tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuspark.operators.blocks import block_offsets, block_of
from locuspark.operators.genotype import MIN_AF
from locuspark.session import stage

SNAP = 1e-9


def strain_numbers(genotypes: DataFrame) -> DataFrame:
    """marker_set_id, strain, _s (its place in the marker set's sorted strains), n_strains."""
    names = genotypes.select("marker_set_id", "strain").distinct()
    in_set = Window.partitionBy("marker_set_id")
    return names.select(
        "marker_set_id",
        "strain",
        (F.row_number().over(in_set.orderBy("strain")) - 1).alias("_s"),
        F.count(F.lit(1)).over(in_set).alias("n_strains"),
    )


def numbered_codes(genotypes: DataFrame) -> DataFrame:
    """marker_set_id, CHROM, POS, ordinal, n_strains, _s, allele: every genotype row with its marker's and strain's number.

    Markers are counted as in ``marker_vectors``. Rows stay narrow and are not
    gathered per marker, which costs more than their products.
    """
    keys = ["marker_set_id", "CHROM", "_block"]
    blocked = genotypes.withColumn("_block", block_of(F.col("POS")))
    offsets = block_offsets(blocked.select(*keys, "POS").distinct(), ("marker_set_id",)).drop("_total")
    rows = blocked.join(strain_numbers(genotypes), ["marker_set_id", "strain"])
    local = F.dense_rank().over(Window.partitionBy(*keys).orderBy("POS"))
    return rows.withColumn("_local", local).join(offsets, keys).select(
        "marker_set_id",
        "CHROM",
        "POS",
        (F.col("_before") + F.col("_local") - 1).alias("ordinal"),
        F.col("n_strains").cast("int").alias("n_strains"),
        "_s",
        F.col("allele").cast("double").alias("allele"),
    )


def marker_vectors(genotypes: DataFrame) -> DataFrame:
    """marker_set_id, CHROM, POS, ordinal, n_strains, strains, alleles.

    ``strains`` are positions in the marker set's sorted strain list, ``alleles``
    the known codes at those positions. The ordinal counts markers along the
    chromosome from 0.
    """
    packed = (
        genotypes.join(strain_numbers(genotypes), ["marker_set_id", "strain"])
        .groupBy("marker_set_id", "CHROM", "POS")
        .agg(
            F.first("n_strains").cast("int").alias("n_strains"),
            F.sort_array(
                F.collect_list(F.when(F.col("allele").isNotNull(), F.struct("_s", "allele")))
            ).alias("_known"),
        )
        .withColumn("_block", block_of(F.col("POS")))
    )
    offsets = block_offsets(packed, ("marker_set_id",)).drop("_total")
    local = Window.partitionBy("marker_set_id", "CHROM", "_block").orderBy("POS")
    return packed.join(offsets, ["marker_set_id", "CHROM", "_block"]).select(
        "marker_set_id",
        "CHROM",
        "POS",
        (F.col("_before") + F.row_number().over(local) - 1).alias("ordinal"),
        "n_strains",
        F.col("_known._s").alias("strains"),
        F.col("_known.allele").alias("alleles"),
    )


def _matrix(rows: pd.DataFrame, n: int) -> np.ndarray:
    """Marker by strain matrix with NaN where unknown."""
    out = np.full((len(rows), n), np.nan)
    sizes = [len(s) for s in rows["strains"]]
    if sum(sizes):
        at = np.repeat(np.arange(len(rows)), sizes)
        out[at, np.concatenate(list(rows["strains"])).astype(int)] = np.concatenate(
            list(rows["alleles"])
        )
    return out


#: Strains along one side of a tile, and partial sums of a tile added up in one task.
TILE, ADDED = 64, 32
_TILES = "marker_set_id string, CHROM string, n int, a int, b int, lot long, cells binary"


def gram_tiles(genotypes: DataFrame, min_af: float = MIN_AF) -> DataFrame:
    """marker_set_id, CHROM, n, a, b, cells: strain-by-strain products of the standardised genotypes, in tiles.

    Tile (a, b) with a <= b holds the products of the strains from ``TILE * a`` with
    those from ``TILE * b``. Every task adds up its markers' part of each tile, and
    tasks add these parts up in two steps. Only markers known in every strain and
    within the frequency bounds take part.
    """
    usable = marker_vectors(genotypes).where(F.size("alleles") == F.col("n_strains"))
    af = F.aggregate("alleles", F.lit(0.0), lambda acc, a: acc + F.when(a > 0, 1.0).otherwise(0.0))
    af = af / F.col("n_strains")
    usable = usable.where((af >= min_af) & (af <= 1 - min_af)).select(
        "marker_set_id", "CHROM", "n_strains", "strains", "alleles"
    )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        lot = TaskContext.get().partitionId() // ADDED
        sums: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            for key, rows in batch.groupby(["marker_set_id", "CHROM"]):
                x = _matrix(rows, int(rows["n_strains"].iloc[0]))
                x = x - x.mean(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                part = x.T @ x
                sums[key] = sums[key] + part if key in sums else part
        for (set_id, chrom), total in sums.items():
            n = len(total)
            rows = [
                (set_id, chrom, n, a // TILE, b // TILE, lot, np.ascontiguousarray(total[a : a + TILE, b : b + TILE]).tobytes())
                for a in range(0, n, TILE)
                for b in range(a, n, TILE)
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _TILES.split(", ")])

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c) for c in rows["cells"])
        return rows.iloc[:1].assign(cells=[total.tobytes()])

    keys = ["marker_set_id", "CHROM", "n", "a", "b"]
    parts = usable.mapInPandas(partial, _TILES).groupBy(*keys, "lot").applyInPandas(added, _TILES)
    return parts.groupBy(*keys).applyInPandas(added, _TILES).drop("lot")


def gram_cells(tiles: DataFrame) -> DataFrame:
    """marker_set_id, CHROM, i, j, v with i <= j: the tiles cell by cell."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples():
                wide = min(TILE, t.n - TILE * t.b)
                v = np.frombuffer(t.cells).reshape(-1, wide)
                i, j = np.indices(v.shape) + np.array([TILE * t.a, TILE * t.b])[:, None, None]
                upper = i <= j
                yield pd.DataFrame({"marker_set_id": t.marker_set_id, "CHROM": t.CHROM, "i": i[upper], "j": j[upper], "v": v[upper]})

    return tiles.mapInPandas(cells, "marker_set_id string, CHROM string, i int, j int, v double")


def independent_tests(genotypes: DataFrame, min_af: float = MIN_AF) -> DataFrame:
    """Effective number of independent tests per marker set and chromosome.

    Counts the eigenvalues of the marker correlation matrix: one for each above
    1, plus every fractional part. The non-zero eigenvalues equal those of the
    strain-by-strain product of the standardised genotypes (``gram_tiles``), so
    only a matrix of panel size is ever decomposed. Eigenvalues within 1e-9 of
    an integer count as that integer.
    """

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        g = np.zeros((n, n))
        for t in rows.itertuples():
            a, b = TILE * t.a, TILE * t.b
            v = np.frombuffer(t.cells).reshape(min(TILE, n - a), -1)
            g[a : a + TILE, b : b + TILE] = v
            g[b : b + TILE, a : a + TILE] = v.T
        value = np.abs(np.linalg.eigvalsh((g + g.T) / 2))
        near = np.rint(value)
        value = np.where(np.abs(value - near) <= SNAP, near, value)
        tests = float((value > 1).sum() + (value - np.floor(value)).sum())
        first = rows.iloc[0]
        return pd.DataFrame(
            {
                "marker_set_id": [first["marker_set_id"]],
                "CHROM": [first["CHROM"]],
                "n_tests": [tests],
            }
        )

    return gram_tiles(genotypes, min_af).groupBy("marker_set_id", "CHROM").applyInPandas(
        count, "marker_set_id string, CHROM string, n_tests double"
    )


def total_independent_tests(per_chrom: DataFrame) -> DataFrame:
    """Sum over chromosomes, printed with six significant digits."""
    total = per_chrom.groupBy("marker_set_id").agg(F.sum("n_tests").alias("_t"))
    return total.select(
        "marker_set_id", F.format_string("%.6g", F.col("_t")).cast("double").alias("n_independent_tests")
    )


#: Markers whose products with their neighbours are taken at once.
STRIP = 64
_PAIRS = "marker_set_id string, CHROM string, i long, j long, pos_a long, pos_b long, r2 double"


def ld_pairs(genotypes: DataFrame, window: int = 50, block: int = 512) -> DataFrame:
    """r-squared of every two markers fewer than ``window`` places apart.

    Markers are cut into blocks of ``block`` along the chromosome; the first
    ``window - 1`` of a block are also given to the block before, so every pair
    is found once, in the block of its first marker. A task gets the codes of a
    block one by one, at most panel size for each marker. Strains unknown in either
    marker are left out of a pair; r-squared is null without variation.
    """
    codes = numbered_codes(genotypes)
    own = F.floor(F.col("ordinal") / block)
    shared = (F.col("ordinal") % block < window - 1) & (own > 0)
    placed = codes.withColumn("_blk", F.explode(F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))))

    def correlate(rows: pa.Table) -> pa.Table:
        first = rows["_blk"][0].as_py() * block
        row, allele = rows["ordinal"].to_numpy() - first, rows["allele"].to_numpy()
        total = int(row.max()) + 1
        lead = min(block, total)
        pos = np.zeros(total, np.int64)
        pos[row] = rows["POS"].to_numpy()
        x = np.full((total, rows["n_strains"][0].as_py()), np.nan)
        np.fmax.at(x, (row, rows["_s"].to_numpy()), allele)
        known = ~np.isnan(x)
        x, m = np.where(known, x, 0.0), known.astype(float)
        a = np.repeat(np.arange(lead), window - 1)
        b = a + np.tile(np.arange(1, window), lead)
        a, b = a[b < total], b[b < total]
        sums = np.empty((6, len(a)))
        for k in range(0, lead, STRIP):
            lo, hi = np.searchsorted(a, [k, k + STRIP])
            here, there = slice(k, min(k + STRIP, lead)), slice(k, k + STRIP + window - 1)
            cells = (a[lo:hi] - k, b[lo:hi] - k)
            for out, (u, v) in zip(sums, ((m, m), (x, m), (m, x), (x * x, m), (m, x * x), (x, x))):
                out[lo:hi] = (u[here] @ v[there].T)[cells]
        n, sa, sb, saa, sbb, sab = sums
        cov = n * sab - sa * sb
        spread = (n * saa - sa * sa) * (n * sbb - sb * sb)
        r2 = np.divide(cov * cov, spread, out=np.full(len(a), np.nan), where=spread > 0)
        names = [pa.repeat(rows[c][0], len(a)) for c in ("marker_set_id", "CHROM")]
        columns = [*names, a + first, b + first, pos[a], pos[b], pa.array(r2, from_pandas=True)]
        return pa.table(columns, names=["marker_set_id", "CHROM", "i", "j", "pos_a", "pos_b", "r2"])

    return placed.groupBy("marker_set_id", "CHROM", "_blk").applyInArrow(correlate, _PAIRS)


def ld_edges(
    pairs: DataFrame, frequencies: DataFrame, r2: float, window: int = 50, step: int = 10
) -> DataFrame:
    """Linked pairs in the order in which they are looked at: marker_set_id, CHROM, at, i, j, loser, winner, pos.

    Windows of ``window`` markers advance by ``step``; a pair is looked at in the
    first window that holds both. ``loser`` is the marker that goes if both are
    there, the rarer one or else the later one, and ``pos`` its position.
    """
    maf = frequencies.select(
        "marker_set_id",
        "CHROM",
        "POS",
        F.least(F.col("af"), 1 - F.col("af")).alias("maf"),
    )
    together = F.col("j") < F.floor(F.col("i") / step) * step + window
    edges = pairs.where((F.col("r2") > r2) & together)
    for side in ("a", "b"):
        edges = edges.join(
            maf.withColumnsRenamed({"POS": f"pos_{side}", "maf": f"maf_{side}"}),
            ["marker_set_id", "CHROM", f"pos_{side}"],
        )
    entered = F.greatest(F.ceil((F.col("j") - (window - 1)) / step), F.lit(0))
    first_goes = F.col("maf_a") < F.col("maf_b")
    return edges.select(
        "marker_set_id",
        "CHROM",
        F.struct(entered.alias("entered"), "i", "j").alias("at"),
        F.when(first_goes, F.col("i")).otherwise(F.col("j")).alias("loser"),
        F.when(first_goes, F.col("j")).otherwise(F.col("i")).alias("winner"),
        F.when(first_goes, F.col("pos_a")).otherwise(F.col("pos_b")).alias("pos"),
    )


def eliminate(edges: DataFrame) -> DataFrame:
    """Markers that go when edges are taken in order and each complete one loses its loser.

    Taken one after the other, an edge counts if neither of its markers went
    before. Whether they did depends only on earlier edges whose loser is one of
    the two. So in every round all edges without such an open edge are settled at
    once: they count, and every later edge of their losers is void. A marker has
    at most as many edges as a window has pairs with it, whatever the chromosome's
    length, so no key of these joins is large. Open edges and markers gone are
    written after every round; the rounds end when no edge is open.
    """
    keys = ["marker_set_id", "CHROM"]
    open_ = stage(edges, "linked")
    gone: DataFrame | None = None
    while not open_.isEmpty():
        first = open_.groupBy(*keys, F.col("loser").alias("marker")).agg(F.min("at").alias("first"))
        placed = open_
        for side in ("loser", "winner"):
            own = first.withColumnsRenamed({"marker": side, "first": f"{side}_first"})
            placed = placed.join(own, [*keys, side], "left")
        threat = F.col("winner_first").isNull() | (F.col("at") < F.col("winner_first"))
        placed = stage(placed.withColumn("counts", (F.col("at") == F.col("loser_first")) & threat), "settled")
        new = placed.where("counts").select(*keys, F.col("loser").alias("marker"), F.col("at").alias("since"), "pos")
        rest = placed.where("not counts")
        for side in ("loser", "winner"):
            since = new.select(*keys, F.col("marker").alias(side), F.col("since").alias(f"{side}_gone"))
            rest = rest.join(since, [*keys, side], "left")
            rest = rest.where(F.col(f"{side}_gone").isNull() | (F.col("at") < F.col(f"{side}_gone")))
        open_ = stage(rest.select(*edges.columns), "linked")
        gone = new if gone is None else gone.unionByName(new)
    if gone is None:
        gone = open_.select(*keys, "pos")
    return gone.select(*keys, F.col("pos").alias("POS"))


def ld_prune(
    pairs: DataFrame, frequencies: DataFrame, r2: float, window: int = 50, step: int = 10
) -> DataFrame:
    """Markers to remove: marker_set_id, CHROM, POS.

    Windows of ``window`` markers advance by ``step``; in each, the rarer marker
    of a still complete pair above ``r2`` goes (the later one when equal).
    """
    return eliminate(ld_edges(pairs, frequencies, r2, window, step))
