"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.llm import decontaminate, exact_dedup, language, lexical, licenses, mixing, near_dedup, negatives, packing, quality, secrets, token_files, topk
from locuspark.llm.common import documents, held_out


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predict(docs.select("doc_id", "text"), language.fit_held_in(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected")
    )


def tree_path(doc_id: Column, source: Column) -> Column:
    """A place for each document in a tree of source, thousand and hundred of its id.

    The first document of a thousand and that of a hundred are the licence files
    of their directories.
    """
    thousand, hundred = F.floor(doc_id / 1000).cast("string"), F.floor(doc_id / 100).cast("string")
    base = F.concat_ws("/", F.coalesce(source, F.lit("none")), thousand)
    return (
        F.when(doc_id % 1000 == 0, F.concat(base, F.lit("/LICENSE")))
        .when(doc_id % 100 == 0, F.concat(base, F.lit("/"), hundred, F.lit("/LICENSE")))
        .otherwise(F.concat(base, F.lit("/"), hundred, F.lit("/"), doc_id.cast("string"), F.lit(".txt")))
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir), tree_path(F.col("doc_id"), F.col("source")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf_dir))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(documents(spark, sf_dir), F.array("source"))
    own = F.col("mix_sources")[0]
    return found.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        own["size"].alias("source_size"),
        own["target"].alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, label)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_probminhash_dedup, op3_language_id, op4_license_scan, op5_secret_scan,
        op6_exact_top_k, op7_best_fit_packing, op8_exact_dedup, op9_source_mixing, op10_token_files,
        op11_hard_negatives, op12_lexical_search, op13_decontamination,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Of a text in lower case: what is neither a digit, nor a letter a-z, nor beyond ASCII separates words.
_WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES: dict[str, str] = {
    "op6_exact_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        ),
        s as (
            select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
            from v q join v c on q.vec_id % 50 = 0 and q.vec_id != c.vec_id
        ),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
    """,
    "op11_hard_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        ),
        s as (
            select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_dot_product(a.e, c.e) as bigint) as score
            from v a join v c on a.vec_id % 100 = 0 and a.vec_id != c.vec_id
        ),
        p as (
            select anchor_id, vec_id as positive_id, score as positive_score,
                   row_number() over (partition by anchor_id order by score desc, vec_id) as n
            from s where same
        ),
        r as (
            select p.anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
                   row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as rank
            from p join s on p.anchor_id = s.anchor_id and not s.same and p.n <= 5
                and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
        )
        select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from r where rank <= 10
    """,
    "op12_lexical_search": rf"""
        with d as (
            select row_number() over () as place, doc_id,
                   regexp_extract_all({_LOWER}, '{_WORD_CLASS}') as words
            from documents where text is not null
        ),
        n as (select place, doc_id, len(words) as n, words from d where len(words) > 0),
        total as (select count(*) as nd, sum(n) as l from n),
        tf as (select place, term, count(*) as tf from (select place, unnest(words) as term from n) group by all),
        df as (select term, count(*) as df from tf group by term),
        w as (select term, cast(floor(1000 * ln((2.0::double * nd + 2) / (2.0::double * df + 1))) as bigint) as w from df, total),
        q as (
            select distinct item_id, term
            from (select item_id, unnest(regexp_extract_all({_LOWER}, '{_WORD_CLASS}')) as term from benchmark)
        ),
        s as (
            select item_id, doc_id, place,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // cast(l as bigint))))) as score
            from q join w using (term) join tf using (term) join n using (place), total
            group by item_id, doc_id, place
        ),
        r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
        select item_id, cast(rank as integer) as rank, doc_id, cast(score as bigint) as score from r where rank <= 50
    """,
    "op13_decontamination": rf"""
        with d as (
            select row_number() over () as place, doc_id,
                   regexp_extract_all({_LOWER}, '{_WORD_CLASS}') as words
            from documents
        ),
        i as (select item_id, regexp_extract_all({_LOWER}, '{_WORD_CLASS}') as words from benchmark),
        iw as (
            select item_id, m, array_to_string(words[s:s + m - 1], ' ') as gram
            from (select *, unnest(range(1, len(words) - m + 2)) as s from (select *, least(10, len(words)) as m from i where len(words) > 0))
        ),
        g as (select distinct m, gram from iw),
        sizes as (select distinct m from iw),
        dw as (
            select place, m, s, array_to_string(words[s:s + m - 1], ' ') as gram
            from (select place, words, m, unnest(range(1, len(words) - m + 2)) as s from d, sizes where len(words) >= m)
        ),
        found as (select place, m, s, gram from dw join g using (m, gram)),
        hit as (select place, count(distinct p) as n_hit from (select place, unnest(range(s, s + m)) as p from found) group by place),
        own as (
            select place, count(distinct item_id) as n_items, array_to_string(list_sort(list_distinct(list(cast(item_id as varchar)))), ',') as items
            from found join iw using (m, gram) group by place
        )
        select doc_id, coalesce(len(words), 0) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join hit using (place) left join own using (place)
    """,
    "op8_exact_dedup": r"""
        with d as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
        ),
        g as (select t, min(doc_id) as keep_id, count(*) as group_size from d group by t)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
        from d join g using (t)
    """,
}
