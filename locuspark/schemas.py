"""Declared table schemas.

Column names, order and types are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _schema(spec: str) -> T.StructType:
    pairs = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


MARKERS = _schema("marker_set_id:string marker:string CHROM:string POS:long A1:string A2:string")

MAPPINGS = _schema("marker:string AF1:double BETA:double SE:double P:double")

METADATA = _schema(
    "mapping_id:string mapping_hash_string:string trait_id:string marker_set_id:string "
    "hash_schema_version:string population:string maf:double nqtl:int rep:int h2:double "
    "effect:string algorithm:string pca:boolean n_markers:int source_file:string "
    "processed_at:timestamp processing_version:string"
)

MARKER_SET_METADATA = _schema(
    "marker_set_id:string marker_set_hash_string:string hash_schema_version:string "
    "population:string maf:double species:string vcf_release_id:string ms_ld:double "
    "n_markers:int n_independent_tests:double eigen_source_file:string "
    "strainfile_hash:string strain_list:string created_at:timestamp"
)

GENOTYPES = _schema("marker_set_id:string CHROM:string POS:long strain:string allele:double")

TRAITS = _schema(
    "trait_id:string trait_hash_string:string marker_set_id:string nqtl:int rep:int h2:double "
    "maf:double effect:string population:string cv_maf_effective:double cv_ld:double "
    "created_at:string"
)

PHENOTYPES = _schema("trait_id:string strain:string phenotype:double")

CAUSAL_VARIANTS = _schema(
    "trait_id:string QTL:string CHROM:string POS:long RefAllele:string Frequency:double "
    "Effect:double"
)

CAUSAL_GENOTYPES = _schema(
    "trait_id:string QTL:string CHROM:string POS:long strain:string allele:double"
)

QTL_REGIONS = _schema(
    "mapping_id:string threshold_method:string peak_id:int CHROM:string startPOS:long "
    "peakPOS:long endPOS:long interval_size:long n_sig_markers:int max_log10p:double "
    "peak_marker:string sig_threshold_value:double ci_size:int snp_grouping:int "
    "algorithm:string population:string maf:double"
)

ANALYSIS_SUMMARY = _schema(
    "mapping_id:string threshold_method:string population:string maf:double algorithm:string "
    "n_markers:int n_significant:int pct_significant:double n_qtl:int max_log10p:double "
    "threshold_value:double ci_size:int snp_grouping:int"
)

ANALYSIS_METADATA = _schema(
    "run_id:string alpha:double ci_size:int snp_grouping:int n_populations:int n_mappings:int "
    "n_qtl_bf:int n_qtl_eigen:int created_at:timestamp"
)

# Assessment output: 35 columns in fixed order; dots become underscores.
ASSESSMENT = _schema(
    "QTL:string Simulated:boolean Detected:boolean CHROM:string POS:long RefAllele:string "
    "Frequency:double Effect:double Simulated_QTL_VarExp:double log10p:double significant:int "
    "BETA:double startPOS:long peakPOS:long endPOS:long detected_peak:string "
    "interval_log10p:double interval_var_exp:double interval_Frequency:double peak_id:int "
    "interval_size:long top_hit:boolean nQTL:string simREP:string h2:string maf:string "
    "effect_distribution:string strain_set_id:string mode:string type:string threshold:string "
    "algorithm_id:string alpha:double ci_size:int snp_grouping:int"
)

STRAINFILE = _schema(
    "group:string species:string vcf:string ms_maf:double ms_ld:double strains:string"
)

REPLAY_MANIFEST = _schema(
    "session:string task_hash:string attempt:int max_retries:int species:string group:string "
    "maf:double nqtl:string effect:string h2:double rep:int mode:string type:string exit:int"
)

WORKDIR_METRICS = _schema(
    "work_hash:string process:string tag:string panel_size:string total_bytes:double "
    "n_files:int n_symlinks:int n_real_files:int largest_file_bytes:double "
    "largest_file_name:string"
)

TABLES = {
    "markers": MARKERS,
    "mappings": MAPPINGS,
    "metadata": METADATA,
    "marker_set_metadata": MARKER_SET_METADATA,
    "genotypes": GENOTYPES,
    "traits": TRAITS,
    "phenotypes": PHENOTYPES,
    "causal_variants": CAUSAL_VARIANTS,
    "causal_genotypes": CAUSAL_GENOTYPES,
    "qtl_regions": QTL_REGIONS,
    "analysis_summary": ANALYSIS_SUMMARY,
    "analysis_metadata": ANALYSIS_METADATA,
}
