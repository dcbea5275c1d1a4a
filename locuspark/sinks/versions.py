"""Versioned tables: deliveries add to or replace what is stored, and a snapshot appears at once.

A table is a folder with ``data`` and ``snapshots``. Every commit writes one
data folder, in id buckets, and then one snapshot: a row per group of rows that
belong together (a mapping, a cell) with its run token and the commits that hold
its rows. A snapshot counts once its marker file is there, so a reader sees the
one before or the one after, never a part.

* Rows with the stored run's token are added to their group; of rows with the
  same key the one that comes later (``at``) stays, in whatever batch it came.
* A higher token replaces the group, a lower one is too late and ignored.
* A commit whose name a snapshot bears is done and not applied again. Once that
  snapshot is gone, applying it again changes nothing: its rows are there, or
  are of a run that was replaced.
* Compaction rewrites the current rows as one commit; vacuuming deletes the
  folders no kept snapshot refers to.

The number of files depends on commits and buckets, not on the number of ids.
Ids carry Bloom filters, and rows are sorted by them, so looking one up reads
the row group of one file per commit that holds it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16
#: Commits after which ``commit`` compacts by itself.
COMPACT_AFTER = 8
_VISIBLE = "_visible"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[f"_m_{k}"])
    return out


@dataclass(frozen=True)
class Versioned:
    """The table at ``path``: groups are named by ``group``, rows within a group by ``row``."""

    spark: SparkSession
    path: str
    group: tuple[str, ...]
    row: tuple[str, ...] = ()
    buckets: int = BUCKETS

    # ---- files ------------------------------------------------------------

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _list(self, folder: str) -> list[str]:
        fs, place = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def snapshots(self) -> list[str]:
        """Names of the visible snapshots, oldest first; a number and the commit's name."""
        out = []
        for name in self._list("snapshots"):
            fs, mark = self._fs(f"{self.path}/snapshots/{name}/{_VISIBLE}")
            if fs.exists(mark):
                out.append(name)
        return out

    def _snapshot(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/snapshots/{name}")

    def _publish(self, groups: DataFrame, name: str) -> None:
        groups.write.mode("overwrite").parquet(f"{self.path}/snapshots/{name}")
        fs, mark = self._fs(f"{self.path}/snapshots/{name}/{_VISIBLE}")
        fs.create(mark, True).close()

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in self.group]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, commit: str) -> None:
        out = rows.withColumn("_bucket", self._bucket()).hint("rebalance", "_bucket")
        writer = out.sortWithinPartitions("_bucket", *self.group, *self.row).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static").option("parquet.bloom.filter.enabled", "false")
        for c in self.group:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.partitionBy("_bucket").parquet(f"{self.path}/data/_commit={commit}")

    # ---- reading ----------------------------------------------------------

    def _data(self, commits: Sequence[str]) -> DataFrame:
        reader = self.spark.read.option("basePath", f"{self.path}/data")
        rows = reader.parquet(*[f"{self.path}/data/_commit={c}" for c in commits])
        return rows.withColumn("_bucket", F.col("_bucket").cast("int"))

    def _current(self, snapshot: str | None = None, only: Column | None = None) -> DataFrame | None:
        """Rows of a snapshot with ``_run`` and ``_at``; ``only`` selects groups."""
        snapshot = snapshot or next(reversed(self.snapshots()), None)
        if snapshot is None:
            return None
        groups = self._snapshot(snapshot)
        if only is not None:
            groups = groups.where(only)
        # Commits since the last compaction; few.
        commits = sorted(r[0] for r in groups.select(F.explode("commits")).distinct().collect())
        if not commits:
            some = self._snapshot(snapshot).select(F.explode("commits")).first()
            return None if some is None else self._data([some[0]]).where("false").drop("_commit", "_bucket")
        rows = self._data(commits)
        if only is not None:
            rows = rows.where(only)
        renamed = groups.withColumnsRenamed({k: f"_m_{k}" for k in self.group}).withColumnRenamed("_run", "_m_run")
        kept = rows.join(renamed, _same(rows, renamed, self.group) & (rows["_run"] == renamed["_m_run"]))
        kept = kept.where(F.array_contains("commits", F.col("_commit")))
        columns = [c for c in rows.columns if c not in ("_commit", "_bucket")]
        whole = kept.where(F.size("commits") == 1).select(*columns)
        if len(commits) == 1:
            return whole
        keys = [*self.group, *self.row]
        rest = [c for c in columns if c not in keys and c != "_at"]
        # Only groups whose rows lie in several commits are merged.
        parts = kept.where(F.size("commits") > 1).groupBy(*keys).agg(F.max(F.struct("_at", *rest)).alias("_last"))
        return whole.unionByName(parts.select(*keys, "_last.*"))

    def read(self, only: Column | None = None) -> DataFrame | None:
        """The current rows, or None where nothing was ever stored."""
        rows = self._current(only=only)
        return None if rows is None else rows.drop("_run", "_at")

    def look_up(self, **key: str) -> DataFrame:
        """The rows of one group, from the files of its bucket alone."""
        only = F.lit(True)
        for k in self.group:
            only = only & (F.col(k) == F.lit(key[k]))
        snapshot = next(reversed(self.snapshots()), None)
        if snapshot is None:
            raise LookupError(f"nothing stored at {self.path}")
        named = self.spark.range(1).select(*[F.lit(str(key[k])).alias(k) for k in self.group])
        bucket = named.select(self._bucket()).first()[0]
        found = self._snapshot(snapshot).where(only).first()
        if found is None:
            raise LookupError(f"nothing stored for {key} at {self.path}")
        rows = self._data(found["commits"]).where((F.col("_bucket") == bucket) & only & (F.col("_run") == found["_run"]))
        columns = [c for c in rows.columns if c not in ("_commit", "_bucket", "_run", "_at")]
        if len(found["commits"]) == 1:
            return rows.select(*columns)
        keys = [*self.group, *self.row]
        rest = [c for c in columns if c not in keys]
        return rows.groupBy(*keys).agg(F.max(F.struct("_at", *rest)).alias("_last")).select(*keys, *[F.col(f"_last.{c}") for c in rest])

    # ---- writing ----------------------------------------------------------

    def commit(self, rows: DataFrame, name: str, run: Column | None = None, at: Column | None = None, drop: Sequence[str] = (), compact_after: int = COMPACT_AFTER) -> None:
        """Apply a delivery under a name of its own.

        ``run`` is the run token of a row (a whole number, 0 for all by default),
        ``at`` says which of two rows with the same key came later; equal ones go
        by their values. Columns named in ``drop`` serve these two and are not stored.
        """
        base = self.snapshots()
        if name in [s.split("-", 1)[1] for s in base]:
            return
        number = int(base[-1].split("-", 1)[0]) + 1 if base else 0
        commit = f"{number:012d}-{name}"
        keys = [*self.group, *self.row]
        run = F.lit(0) if run is None else run
        at = F.lit(0) if at is None else at
        values = [c for c in rows.columns if c not in (*keys, *drop)]
        marked = rows.select(*keys, run.cast("long").alias("_run"), at.alias("_at"), F.struct(*values, F.lit(0).alias("_")).alias("_row"))
        last = marked.groupBy(*keys).agg(F.max(F.struct("_run", "_at", "_row")).alias("_last"))
        flat = last.select(*keys, "_last._run", "_last._at", *[F.col("_last._row")[c].alias(c) for c in values])
        self._write(flat, commit)
        # An empty delivery leaves no file to take a schema from.
        came = self.spark.read.schema(flat.schema).parquet(f"{self.path}/data/_commit={commit}").groupBy(*self.group).agg(F.max("_run").alias("_run"))
        came = came.withColumn("commits", F.array(F.lit(commit)))
        if base:
            old = self._snapshot(base[-1])
            new = came.withColumnsRenamed({k: f"_m_{k}" for k in self.group}).withColumnsRenamed({"_run": "_new_run", "commits": "_new"})
            both = old.join(new, _same(old, new, self.group), "full")
            later = F.col("_run").isNull() | (F.col("_new_run") > F.col("_run"))
            commits = F.when(F.col("_new").isNull() | (F.col("_new_run") < F.col("_run")), F.col("commits"))
            commits = commits.when(later, F.col("_new")).otherwise(F.concat("commits", "_new"))
            came = both.select(
                *[F.when(F.col("_run").isNull(), F.col(f"_m_{k}")).otherwise(F.col(k)).alias(k) for k in self.group],
                F.greatest("_run", "_new_run").alias("_run"),
                commits.alias("commits"),
            )
        self._publish(came, commit)
        if len(self._snapshot(commit).select(F.explode("commits")).distinct().limit(compact_after + 1).collect()) > compact_after:
            self.compact()
            self.vacuum()

    def compact(self) -> None:
        """Rewrite the current rows as one commit under a new snapshot."""
        last = self.snapshots()[-1]
        number, name = last.split("-", 1)
        commit = f"{int(number) + 1:012d}-{name}"
        self._write(self._current(last), commit)
        self._publish(self._snapshot(last).withColumn("commits", F.array(F.lit(commit))), commit)

    def vacuum(self, keep: int = 1) -> None:
        """Delete snapshots but the last ``keep``, and data that these do not name."""
        kept = self.snapshots()[-keep:]
        if not kept:
            return
        named = set()
        for s in kept:
            named |= {r[0] for r in self._snapshot(s).select(F.explode("commits")).distinct().collect()}
        for s in self._list("snapshots"):
            if s not in kept and s < kept[-1]:
                fs, place = self._fs(f"{self.path}/snapshots/{s}")
                fs.delete(place, True)
        for d in self._list("data"):
            commit = d.removeprefix("_commit=")
            if commit not in named and commit < kept[-1]:
                fs, place = self._fs(f"{self.path}/data/{d}")
                fs.delete(place, True)
