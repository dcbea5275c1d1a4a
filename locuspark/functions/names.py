"""File-name, label and text-field functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name patterns, suffixes and allowed words.
MAPPING_NAME = (
    r"^(\d+)_(\d+)_([0-9.]+)_([0-9.]+)_([a-zA-Z]+)_(.+)"
    r"_processed_LMM-EXACT-(INBRED|LOCO)(_PCA)?_mapping\.tsv$"
)
RESULT_NAME = (
    r"^(\d+)_(\d+)_([0-9.]+)_([0-9.]+)_([a-zA-Z]+)_(.+)_lmm-exact_(inbred|loco)_(pca|nopca)$"
)
EIGEN_NAME = r"^(.+)_([0-9.]+)_total_independent_tests\.txt$"
EIGEN_SUFFIX = "_total_independent_tests.txt"
SPECIES = ("c_elegans", "c_briggsae", "c_tropicalis")
RELEASE_RUN = r"(\d{8})"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _group(text: Column, pattern: str, index: int) -> Column:
    return F.regexp_extract(text, pattern, index)


def _described(text: Column, pattern: str, pca: str) -> Column:
    """The eight groups of a base name; ``pca`` is what the last one holds with components.

    One match gives all groups, with the slash between them that a base name cannot hold.
    """
    groups = F.split(F.regexp_replace(text, pattern, "$1/$2/$3/$4/$5/$6/$7/$8/"), "/")

    def record(g: Column) -> Column:
        return F.when(
            F.size(g) == 9,
            F.struct(
                g[0].cast("int").alias("nqtl"),
                g[1].cast("int").alias("rep"),
                g[2].try_cast("double").alias("h2"),
                g[3].try_cast("double").alias("maf"),
                g[4].alias("effect"),
                g[5].alias("population"),
                g[6].alias("algorithm"),
                (g[7] == pca).alias("pca"),
            ),
        )

    # The function binds the groups, which a repeated column would match again for every field.
    return F.transform(F.array(groups), record)[0]


def parse_mapping_name(name: Column) -> Column:
    """Parameters encoded in a processed-mapping file name; null when it does not match.

    Reprocessed and region variants are read as the mapping they came from.
    """
    text = base_name(name)
    text = F.regexp_replace(text, r"_qtl_regions_reprocessed\.tsv$", "_mapping.tsv")
    text = F.regexp_replace(text, r"_mapping_reprocessed\.tsv$", "_mapping.tsv")
    text = F.regexp_replace(text, r"_reprocessed\.tsv$", ".tsv")
    return _described(text, MAPPING_NAME, "_PCA")


def parse_result_name(name: Column) -> Column:
    """Parameters encoded in a raw association-result file name; null when it does not match."""
    text = F.regexp_replace(base_name(name), r"\.[^.]*$", "")
    return _described(text, RESULT_NAME, "pca")


def parse_eigen_name(name: Column) -> Column:
    """struct<population, maf> from an independent-test file name, or null."""
    text = base_name(name)
    record = F.struct(
        _group(text, EIGEN_NAME, 1).alias("population"),
        _group(text, EIGEN_NAME, 2).try_cast("double").alias("maf"),
    )
    return F.when(text.rlike(EIGEN_NAME), record)


def eigen_name(population: Column, maf: Column) -> Column:
    return F.concat(population, F.lit("_"), maf.cast("string"), F.lit(EIGEN_SUFFIX))


def output_name(name: Column, suffix: str = "_reprocessed") -> Column:
    """Insert ``suffix`` before the ``.tsv`` of the base name."""
    return F.concat(F.regexp_replace(base_name(name), r"\.tsv$", ""), F.lit(f"{suffix}.tsv"))


def normalize_species(c: Column, strict: bool = True) -> Column:
    """Trimmed lower-case species; an unknown one fails (or is null when not strict)."""
    text = F.lower(F.trim(c))
    known = F.when(text.isin(*SPECIES), text)
    if not strict:
        return known
    return known.otherwise(F.raise_error(F.concat(F.lit("unknown species: "), text)))


def release_id(c: Column, strict: bool = True) -> Column:
    """Eight digits as given, else the first run of eight digits in the file name."""
    found = _group(base_name(c), RELEASE_RUN, 1)
    out = F.when(c.rlike(r"^\d{8}$"), c).when(found != "", found)
    if not strict:
        return out
    return out.otherwise(F.raise_error(F.concat(F.lit("no release date in: "), c)))


def parse_effect(c: Column) -> Column:
    """``gamma`` or ``lo-hi`` as struct<family, lo, hi>; anything else is null."""
    bounds = F.split(c, "-")
    lo = F.element_at(bounds, 1).try_cast("double")
    hi = F.try_element_at(bounds, F.lit(2)).try_cast("double")
    number = F.lit(None).cast("double")
    return F.when(
        c == "gamma",
        F.struct(F.lit("gamma").alias("family"), number.alias("lo"), number.alias("hi")),
    ).when(
        lo.isNotNull() & hi.isNotNull(),
        F.struct(F.lit("uniform").alias("family"), lo.alias("lo"), hi.alias("hi")),
    )


def algorithm_label(algorithm: Column, pca: Column, threshold: Column) -> Column:
    arm = F.when(F.coalesce(pca, F.lit(False)), F.lit("_PCA_")).otherwise(F.lit("_noPCA_"))
    return F.concat(algorithm, arm, threshold)


def normalize_algorithm(c: Column) -> Column:
    """Upper-case label without the solver prefix, for matching two label styles."""
    return F.regexp_replace(F.upper(c), "^LMM-EXACT-", "")
