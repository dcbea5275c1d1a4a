"""Lines of text tables, every one accounted for.

A line is a header, blank, a row, or a reject with its problem. Readers fail on
rejects by default, naming the file and the line's text; they can leave them
out, and the rejects are a table of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locuspark.functions.scores import clean_number

# Texts that stand for an unknown number.
UNKNOWN = ("NA", "NaN", "nan", "-nan", ".", "")


def words(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")


def number(c: Column) -> Column:
    """Double; unreadable text, ``NA`` and NaN are null."""
    return clean_number(c.try_cast("double"))


@dataclass(frozen=True)
class Lines:
    """Lines split at white space: ``raw``, ``kind``, ``problem``, ``source_file`` and one text column per field."""

    table: DataFrame
    fields: tuple[str, ...]

    def rows(self, bad: str = "fail") -> DataFrame:
        """The fields and source_file of all rows; ``bad`` is ``fail`` or ``skip``."""
        if bad not in ("fail", "skip"):
            raise ValueError(f"bad is fail or skip, not {bad}")
        kept = F.col("kind") == "row"
        if bad == "fail":
            text = F.concat("source_file", F.lit(": "), "problem", F.lit(" in: "), F.substring("raw", 1, 200))
            kept = F.when(F.col("kind") == "reject", F.raise_error(text).cast("boolean")).otherwise(kept)
        return self.table.where(kept).select(*self.fields, "source_file")

    def numbered(self, kind: str) -> DataFrame:
        """The lines of one kind with their number in the file, ``line`` (from 1).

        Lines are numbered by the sizes of the splits before them; of other lines
        only counts per split are moved.
        """
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        placed = self.table.withColumns({"_split": F.spark_partition_id(), "_place": place})
        part = ["path", "_block", "_split"]
        splits = placed.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        # One row per split of a file.
        earlier = Window.partitionBy("path").orderBy("_block", "_split").rowsBetween(Window.unboundedPreceding, -1)
        starts = splits.select(*part, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
        line = F.col("_start") + F.col("_place") - F.col("_first") + 1
        found = placed.where(F.col("kind") == kind).join(starts, part)
        return found.select("source_file", "path", line.alias("line"), "raw", "problem", *self.fields)

    def rejects(self) -> DataFrame:
        """source_file, line, raw, problem of every reject."""
        return self.numbered("reject").select("source_file", "line", "raw", "problem")

    def account(self) -> DataFrame:
        """source_file, n_lines, n_header, n_blank, n_rows, n_rejected: the last four add up to the first."""
        count = {k: F.count(F.when(F.col("kind") == k, 1)) for k in ("header", "blank", "row", "reject")}
        return self.table.groupBy("source_file").agg(
            F.count(F.lit(1)).alias("n_lines"),
            count["header"].alias("n_header"),
            count["blank"].alias("n_blank"),
            count["row"].alias("n_rows"),
            count["reject"].alias("n_rejected"),
        )


def read_lines(
    spark: SparkSession,
    path: str,
    fields: Sequence[str],
    whole: Sequence[str] = (),
    numbers: Sequence[str] = (),
    header: tuple[str, str] | None = None,
    only: str | None = None,
) -> Lines:
    """Every line of a file, or of all files below a folder.

    A row has the named fields (more may follow); those in ``whole`` hold whole
    numbers, those in ``numbers`` numbers or a text for an unknown one. A line
    whose field ``header[0]`` is ``header[1]`` is a header. ``only`` is a pattern
    of file names.

    Words and problem are generated as a row: a filter on ``kind`` is not pushed
    below that, where it would split the line again for every field and check.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = (reader if only is None else reader.option("pathGlobFilter", only)).text(path)
    split = lines.select(
        F.col("value").alias("raw"),
        F.explode(F.array(words(F.col("value")))).alias("_w"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    cell = {name: F.try_element_at(F.col("_w"), F.lit(i + 1)) for i, name in enumerate(fields)}
    problem = F.when(F.size("_w") < len(fields), F.concat(F.size("_w").cast("string"), F.lit(f" fields instead of {len(fields)}")))
    for name in whole:
        problem = problem.when(cell[name].try_cast("long").isNull(), F.concat(F.lit(f"{name} is not a whole number: "), cell[name]))
    for name in numbers:
        unreadable = cell[name].try_cast("double").isNull() & ~cell[name].isin(*UNKNOWN)
        problem = problem.when(unreadable, F.concat(F.lit(f"{name} is not a number: "), cell[name]))
    blank = (F.size("_w") == 1) & (F.col("_w")[0] == "")
    is_header = F.lit(False) if header is None else F.coalesce(cell[header[0]] == header[1], F.lit(False))
    kind = F.when(blank, "blank").when(is_header, "header").when(F.col("problem").isNotNull(), "reject").otherwise("row")
    table = split.select("*", F.explode(F.array(problem)).alias("problem")).select(
        "raw", "source_file", "path", "_block", kind.alias("kind"), "problem", *[c.alias(n) for n, c in cell.items()]
    )
    return Lines(table, tuple(fields))
