"""Column functions: everything here maps columns to columns, JVM-side."""

from locuspark.functions.genotype import recode_gt
from locuspark.functions.ids import mapping_id, marker_set_id, trait_id, with_ids
from locuspark.functions.names import (
    algorithm_label,
    eigen_name,
    normalize_algorithm,
    normalize_species,
    output_name,
    parse_effect,
    parse_eigen_name,
    parse_mapping_name,
    parse_result_name,
    release_id,
)
from locuspark.functions.scores import (
    clean_number,
    interval_jaccard,
    make_marker,
    safe_log10p,
    significance_threshold,
    split_marker,
    with_position,
)

__all__ = [
    "algorithm_label",
    "clean_number",
    "eigen_name",
    "interval_jaccard",
    "make_marker",
    "mapping_id",
    "marker_set_id",
    "normalize_algorithm",
    "normalize_species",
    "output_name",
    "parse_effect",
    "parse_eigen_name",
    "parse_mapping_name",
    "parse_result_name",
    "recode_gt",
    "release_id",
    "safe_log10p",
    "significance_threshold",
    "split_marker",
    "trait_id",
    "with_ids",
    "with_position",
]
