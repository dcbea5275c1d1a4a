"""Binary genotype filesets."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.session import qualified_uri
from locuspark.sources.plink import ALLELES, BED_MAGIC

_CODES = {-1.0: ALLELES.index(-1.0), 1.0: ALLELES.index(1.0)}
MISSING_CODE = ALLELES.index(None)


def write_bed(genotypes: DataFrame, samples: list[str], folder: str, keys: tuple[str, ...] = ("CHROM",)) -> DataFrame:
    """One fileset per value of ``keys`` in ``folder``; returns prefix and n_variants of each.

    ``genotypes`` has CHROM, POS, strain, allele (-1, 1 or null); variants are
    written in the order of their positions, a strain without a row as missing.
    A task goes through its filesets in order, a batch of packed variants at a time:
    neither it nor a worker holds a fileset, however many variants that has. Files
    are written under other names and renamed, so a repeated task leaves the same
    files. The bounded dimension is samples (a panel).
    """
    base = qualified_uri(genotypes.sparkSession, folder)
    width = (len(samples) + 3) // 4
    fam = "".join(f"{s} {s} 0 0 0 -9\n" for s in samples).encode()
    names = [f"_k{i}" for i in range(len(keys))]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, root = fs.FileSystem.from_uri(base)
        filesystem.create_dir(root, recursive=True)
        own, drafts, n = None, {}, 0

        def opened() -> dict:
            files = {ending: f"{root}/_{uuid.uuid4().hex}" for ending in ("bim", "fam", "bed")}
            files = {ending: (draft, filesystem.open_output_stream(draft)) for ending, draft in files.items()}
            files["fam"][1].write(fam)
            files["bed"][1].write(BED_MAGIC)
            return files

        def closed() -> pa.RecordBatch:
            name = "-".join(own)
            for ending, (draft, out) in drafts.items():
                out.close()
                filesystem.move(draft, f"{root}/{name}.{ending}")
            return pa.RecordBatch.from_pydict({"prefix": pa.array([f"{base}/{name}"]), "n_variants": pa.array([n], pa.int64())})

        for batch in batches:
            calls = batch.column("calls")
            codes = np.zeros((len(batch), 4 * width), np.uint8)
            codes[:, : len(samples)] = MISSING_CODE
            call, line = calls.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(batch)), calls.value_lengths().to_numpy())
            codes[line, call >> 2] = call & 3
            bed = np.packbits(np.stack([codes & 1, codes >> 1], axis=2).reshape(len(codes), -1), axis=1, bitorder="little")
            sets = list(zip(*[[str(k) for k in batch.column(name).to_pylist()] for name in names]))
            bim = [f"{c}\t{c}:{p}\t0\t{p}\tA\tG\n" for c, p in zip(batch.column("CHROM").to_pylist(), batch.column("POS").to_pylist())]
            at = 0
            while at < len(batch):
                if sets[at] != own:
                    if own is not None:
                        yield closed()
                    own, drafts, n = sets[at], opened(), 0
                end = at
                while end < len(batch) and sets[end] == own:
                    end += 1
                drafts["bim"][1].write("".join(bim[at:end]).encode())
                drafts["bed"][1].write(bed[at:end].tobytes())
                n, at = n + end - at, end
        if own is not None:
            yield closed()

    # A call is its sample's place and two bits; a variant is the list of its calls.
    place = F.create_map(*[F.lit(x) for i, s in enumerate(samples) for x in (s, i)])[F.col("strain")]
    place = F.coalesce(place, F.raise_error(F.concat(F.lit("not a sample: "), F.coalesce("strain", F.lit("null")))).cast("int"))
    code = F.lit(MISSING_CODE)
    for allele, known in _CODES.items():
        code = F.when(F.col("allele") == allele, known).otherwise(code)
    rows = genotypes.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "CHROM", "POS", (place * 4 + code).alias("call"))
    variants = rows.groupBy(*names, "CHROM", "POS").agg(F.sort_array(F.collect_list("call")).alias("calls"))
    dealt = variants.repartition(*names).sortWithinPartitions(*names, "CHROM", "POS")
    return dealt.mapInArrow(write, "prefix string, n_variants long")
