"""Deterministic identifiers.

An identifier is the first 20 hex characters of the SHA-256 of a canonical
string; each level embeds its parent's identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layout versions, digits and the shape of an identifier.
MARKER_SET_LAYOUT = "v=2"
TRAIT_LAYOUT = "v=2"
MAPPING_LAYOUT = "v=1"
ID_LENGTH = 20
ID_PATTERN = "^[0-9a-f]{20}$"


def _decimal(c: Column) -> Column:
    return F.format_string("%.10f", c.cast("double"))


def _whole(c: Column) -> Column:
    return c.cast("int").cast("string")


def _name(c: Column) -> Column:
    return F.lower(F.trim(c))


def _canonical(layout: str, **fields: Column) -> Column:
    parts = [F.lit(layout)]
    parts += [F.concat(F.lit(f"{name}="), value) for name, value in fields.items()]
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("|"), part)
    return joined


def _hashed(text: Column) -> Column:
    return F.struct(
        F.substring(F.sha2(text, 256), 1, ID_LENGTH).alias("hash"), text.alias("hash_string")
    )


def _checked_parent(parent: Column) -> Column:
    return F.when(parent.rlike(ID_PATTERN), parent).otherwise(
        F.raise_error(F.concat(F.lit("not a parent identifier: "), F.coalesce(parent, F.lit("null"))))
    )


def marker_set_id(
    population: Column, maf: Column, species: Column, release: Column, ms_ld: Column
) -> Column:
    """struct<hash, hash_string> of a marker set."""
    return _hashed(
        _canonical(
            MARKER_SET_LAYOUT,
            population=_name(population),
            maf=_decimal(maf),
            species=_name(species),
            vcf_release_id=release,
            ms_ld=_decimal(ms_ld),
        )
    )


def trait_id(
    parent: Column,
    nqtl: Column,
    effect: Column,
    rep: Column,
    h2: Column,
    cv_maf: Column,
    cv_ld: Column,
) -> Column:
    """struct<hash, hash_string> of a simulated trait below a marker set."""
    return _hashed(
        _canonical(
            TRAIT_LAYOUT,
            parent=_checked_parent(parent),
            nqtl=_whole(nqtl),
            effect=_name(effect),
            rep=_whole(rep),
            h2=_decimal(h2),
            cv_maf_effective=_decimal(cv_maf),
            cv_ld=_decimal(cv_ld),
        )
    )


def mapping_id(parent: Column, algorithm: Column, pca: Column) -> Column:
    """struct<hash, hash_string> of one mapping of a trait."""
    flag = (
        F.when(pca, F.lit("TRUE"))
        .when(~pca, F.lit("FALSE"))
        .otherwise(F.raise_error(F.lit("pca must not be null")))
    )
    return _hashed(
        _canonical(
            MAPPING_LAYOUT, parent=_checked_parent(parent), algorithm=_name(algorithm), pca=flag
        )
    )


# The parameters the whole chain needs, in hashing order.
CHAIN_PARAMETERS = (
    "population maf species vcf_release_id ms_ld nqtl effect rep h2 cv_maf_effective cv_ld"
).split()


def with_ids(grid: DataFrame, include_mapping: bool = True) -> DataFrame:
    """Add marker_set_id, trait_id and (optionally) mapping_id to every grid row.

    A null in any chain parameter fails the job, as a silent null id would turn
    into a missing cell later on.
    """
    absent = F.concat_ws(
        ",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in CHAIN_PARAMETERS]
    )
    population = F.when(absent == "", F.col("population")).otherwise(
        F.raise_error(F.concat(F.lit("missing id parameters: "), absent))
    )
    out = grid.withColumn(
        "marker_set_id",
        marker_set_id(
            population, F.col("maf"), F.col("species"), F.col("vcf_release_id"), F.col("ms_ld")
        )["hash"],
    ).withColumn(
        "trait_id",
        trait_id(
            F.col("marker_set_id"),
            F.col("nqtl"),
            F.col("effect"),
            F.col("rep"),
            F.col("h2"),
            F.col("cv_maf_effective"),
            F.col("cv_ld"),
        )["hash"],
    )
    if not include_mapping:
        return out
    return out.withColumn(
        "mapping_id", mapping_id(F.col("trait_id"), F.col("algorithm"), F.col("pca"))["hash"]
    )
