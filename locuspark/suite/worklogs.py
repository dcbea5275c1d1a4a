"""Work-directory usage."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuspark.operators import sets
from locuspark.operators import workdir as W
from locuspark.suite.assessment import rounded
from locuspark.suite.domain import Domain
from locuspark.suite.oracle import rnd
from locuspark.suite.registry import query


def metrics(d: Domain):
    return W.join_workdir(d.work_tasks, d.work_usage, d.work_files)


def derived(d: Domain):
    return d.staged("workdir", lambda: W.derive_workdir_fields(metrics(d)))


_PANEL = r"""case when regexp_matches({0}, '\.n') and regexp_extract(regexp_replace({0}, '^.*\.n', ''), '^([0-9]+)', 1) <> ''
   then regexp_extract(regexp_replace({0}, '^.*\.n', ''), '^([0-9]+)', 1) end"""
_JOINED = f"""w1 as (select work_dir, count(*) as n_files, count(*) filter (kind = 'l') as n_symlinks,
    count(*) filter (kind <> 'l') as n_real_files from work_files group by work_dir),
 w2 as (select * from (select *, row_number() over (partition by work_dir order by bytes desc, file_name) as rn
        from work_files where kind <> 'l' and bytes > 0) z where rn = 1),
 w3 as (select w1.work_dir as work_hash, coalesce(t.process, 'UNKNOWN') as process, coalesce(t.tag, '') as tag,
    coalesce({_PANEL.format("coalesce(t.tag, '')")}, {_PANEL.format("coalesce(w2.file_name, '')")}, 'NA') as panel_size,
    coalesce(u.total_bytes, cast(0 as double)) as total_bytes, n_files, n_symlinks, n_real_files,
    coalesce(w2.bytes, cast(0 as double)) as largest_file_bytes, coalesce(w2.file_name, '') as largest_file_name
  from w1 left join w2 on w2.work_dir = w1.work_dir left join work_tasks t on t.work_dir = w1.work_dir
  left join work_usage u on u.work_dir = w1.work_dir)"""
_DERIVED = _JOINED + r""",
 w4 as (select * replace (case when trim(regexp_replace(process, '^nf-', '')) = '' then 'UNKNOWN'
            else trim(regexp_replace(process, '^nf-', '')) end as process),
    try_cast(panel_size as int) as panel_size_n, n_symlinks / greatest(n_files, 1) as symlink_frac,
    total_bytes / 1e9 as total_gb,
    case when regexp_extract(largest_file_name, '\.[^./]+$', 0) = '' then '(none)'
         else regexp_extract(largest_file_name, '\.[^./]+$', 0) end as largest_ext from w3),
 w5 as (select *, case process when 'GCTA_PERFORM_GWA' then '3_GWAS' when 'GCTA_MAKE_GRM' then '3_GWAS'
            when 'PLINK_RECODE_MS_VCF' then '1_PrepMarkers' when 'DB_MIGRATION_ASSESS_SIMS' then '4_DB'
            else '5_Unknown' end as phase from w4)"""


@query(
    "joi21_join_workdir",
    f"""with {_JOINED} select work_hash, process, tag, panel_size, {rnd('total_bytes', 3)} as total_bytes, n_files,
        n_symlinks, n_real_files, {rnd('largest_file_bytes', 3)} as largest_file_bytes, largest_file_name from w3""",
)
def _(d):
    return rounded(metrics(d), 3)


@query(
    "sca18_workdir_fields",
    f"""with {_DERIVED} select work_hash, process, panel_size_n, {rnd('symlink_frac')} as symlink_frac,
        {rnd('total_gb')} as total_gb, largest_ext, phase from w5""",
)
def _(d):
    return rounded(
        W.derive_workdir_fields(metrics(d)).select(
            "work_hash", "process", "panel_size_n", "symlink_frac", "total_gb", "largest_ext", "phase"
        )
    )


_STATS = f"""select s.process, s.phase, n_tasks, {rnd('median_gb', 6)} as median_gb, {rnd('mean_gb', 6)} as mean_gb,
   {rnd('p95_gb', 6)} as p95_gb, {rnd('total_gb_sum', 4)} as total_gb_sum, {rnd('median_symlink_f', 6)} as median_symlink_f,
   x.largest_ext as top_ext from (
   select process, phase, count(*) as n_tasks, quantile_cont(total_gb, 0.5) as median_gb, avg(total_gb) as mean_gb,
     quantile_cont(total_gb, 0.95) as p95_gb, sum(total_gb) as total_gb_sum,
     quantile_cont(symlink_frac, 0.5) as median_symlink_f from w5 group by process, phase) s
   join (select * from (select process, phase, largest_ext, row_number() over (partition by process, phase
           order by count(*) desc, largest_ext) as rn from w5 group by process, phase, largest_ext) q where rn = 1) x
     on x.process = s.process and x.phase = s.phase"""


@query("agg27_process_stats", f"with {_DERIVED} {_STATS}")
def _(d):
    return rounded(W.process_stats(derived(d)), 6, total_gb_sum=4)


@query(
    "agg28_panel_stats",
    f"""with {_DERIVED} select process, panel_size_n, count(*) as n_tasks,
        {rnd('quantile_cont(total_gb, 0.5)', 6)} as median_gb, {rnd('avg(total_gb)', 6)} as mean_gb,
        {rnd('quantile_cont(total_gb, 0.95)', 6)} as p95_gb, {rnd('sum(total_gb)', 5)} as total_gb
        from w5 where process in ('PLINK_RECODE_MS_VCF', 'GCTA_MAKE_GRM', 'GCTA_PERFORM_GWA')
          and panel_size_n is not null group by process, panel_size_n""",
)
def _(d):
    return rounded(W.panel_stats(derived(d)), 6, total_gb=5)


_EXT = "select process, phase, largest_ext, count(*) as n from w5 group by process, phase, largest_ext"


def extension_counts(d: Domain):
    return derived(d).groupBy("process", "phase", "largest_ext").agg(F.count(F.lit(1)).alias("n"))


@query(
    "win07_share",
    f"""with {_DERIVED} select process, phase, largest_ext, n,
        {rnd('n / sum(n) over (partition by process)')} as pct from ({_EXT}) z""",
)
def _(d):
    return rounded(sets.share(extension_counts(d), ["process"]))


@query(
    "srt02_top_processes",
    f"""with {_DERIVED} select process, n_tasks, {rnd('gb', 4)} as total_gb_sum from (
          select *, rank() over (order by gb desc) as rk from (
            select process, count(*) as n_tasks, sum(total_gb) as gb from w5 group by process) y) z where rk <= 3""",
)
def _(d):
    stats = derived(d).groupBy("process").agg(
        F.count(F.lit(1)).alias("n_tasks"), F.sum("total_gb").alias("total_gb_sum")
    )
    return rounded(W.top_processes(stats, 3), 4)


@query(
    "srt04_lump_other",
    f"""with {_DERIVED}, e as ({_EXT}), t as (select largest_ext from (select largest_ext, sum(n) as s from e
          group by largest_ext) q order by s desc, largest_ext limit 2)
        select process, phase, case when largest_ext in (select largest_ext from t) then largest_ext else 'other' end
          as largest_ext, n from e""",
)
def _(d):
    return W.lump_other(extension_counts(d), "largest_ext", 2)
