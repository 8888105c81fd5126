"""A keyed table whose upsert rewrites only the buckets it touches.

The table lies in ``version=N/bucket=B`` folders. A row's bucket is a hash of
its business key, so a source row and the target row it matches share one. An
upsert stages the source with its buckets, reads the target's folders of
*those* buckets (by path: nothing else is listed or scanned), merges, and
writes them as the next version; the other buckets stay where they are. A
reader takes each bucket from the newest complete version (one with
``_SUCCESS``) that has it, so a failed or running write is never seen and every
version remains readable as a whole.

The staged source is a written table, so Catalyst knows its bytes. Below
``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and no target row is
shuffled; above it the touched buckets meet the source in one full outer join.

One writer at a time holds the claim of a version, and with it the range of
new ids: the claim's file is created exclusively, and a writer that finds the
next version claimed stops with ``ConcurrentWriteError`` before it reads
anything. ``stale_after`` seconds after it was made, the claim of a version
that never came to be no longer counts; the next number is taken then.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.changes import change_set
from ledgerflow.operators.joins import any_null, lookup_join
from ledgerflow.operators.keys import assign_surrogate_keys
from ledgerflow.operators.upsert import ACTION, ROW, assert_unique_keys, is_small, keep_latest, key_column, merge_frames, merge_observation, merge_parts, stage_source
from ledgerflow.plans import claims
from ledgerflow.session import remove_path

BUCKET = "bucket"
_MAX_ID = "_max_id="


def routed(df: DataFrame, keys: Sequence[str], n_buckets: int, case_insensitive: bool = False, collation: str | None = None) -> DataFrame:
    """``df`` with the bucket of each row: a hash of its key as the merge
    compares it. Rows with a NULL in the key match nothing and are spread."""
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_buckets)).cast("int")
    key = [key_column(df, k, case_insensitive, collation) for k in keys]
    if collation is None:
        hashed = F.pmod(F.xxhash64(*key), F.lit(n_buckets)).cast("int")
        return df.withColumn(BUCKET, F.when(any_null(keys), spread).otherwise(hashed))
    # the hash functions go by bytes; Spark's partitioning goes by the collation
    dealt = df.where(~any_null(keys)).repartition(n_buckets, *key).withColumn(BUCKET, F.spark_partition_id())
    return dealt.unionByName(df.where(any_null(keys)).withColumn(BUCKET, spread))


@dataclass
class BucketTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    n_buckets: int = 64
    case_insensitive: bool = False
    collation: str | None = None
    identity_col: str | None = None
    stale_after: float = 24 * 3600.0
    bucket_by: Sequence[str] | None = None  # some of the keys, whose rows share a bucket; None: all keys

    def __post_init__(self) -> None:
        self.path = self.path.rstrip("/")
        made = [n for n in claims.children(self.spark, self.path, dirs=False) if n.startswith("_buckets=")]
        if made:  # a table keeps the number it was made with
            self.n_buckets = int(made[0].split("=")[1])

    # ------------------------------------------------------------- versions

    def versions(self, complete: bool = True) -> list[int]:
        """Version numbers, oldest first; with ``complete=False`` those of
        failed and running attempts too."""
        found = [int(n.split("=")[1]) for n in claims.children(self.spark, self.path, dirs=True) if n.startswith("version=")]
        if complete:
            found = [v for v in found if claims.exists(self.spark, f"{self._folder(v)}/_SUCCESS")]
        return sorted(found)

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def layout(self, version: int | None = None) -> dict[int, int]:
        """Bucket -> the version that holds it, as of ``version`` (default: the
        newest complete one)."""
        out: dict[int, int] = {}
        for v in self.versions():
            if version is None or v <= version:
                for name in claims.children(self.spark, self._folder(v), dirs=True):
                    if name.startswith(f"{BUCKET}="):
                        out[int(name.split("=")[1])] = v
        return out

    def read(self, buckets: Sequence[int] | None = None, version: int | None = None, keep_bucket: bool = False) -> DataFrame:
        """The table's rows, or those of some buckets."""
        layout = self.layout(version)
        paths = [f"{self._folder(v)}/{BUCKET}={b}" for b, v in sorted(layout.items()) if buckets is None or b in set(buckets)]
        columns = [*self.schema.fieldNames(), *([BUCKET] if keep_bucket else [])]
        full = T.StructType([*self.schema.fields, T.StructField("version", T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], full).select(*columns)
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*paths).select(*columns)

    # --------------------------------------------------------------- claims

    def _claims(self) -> list[str]:
        return claims.children(self.spark, f"{self.path}/_claims", dirs=False)

    def _next_version(self) -> int:
        """The number after every folder and claim; raises while a claim
        without a complete version is younger than ``stale_after``."""
        done = set(self.versions())
        seen = [*self.versions(complete=False)]
        for name in self._claims():
            if name.startswith("version="):
                v = int(name.split("=")[1])
                seen.append(v)
                if v not in done and claims.age(self.spark, f"{self.path}/_claims/{name}") < self.stale_after:
                    raise claims.ConcurrentWriteError(f"version {v} of {self.path} is being written by another writer")
        return max(seen, default=0) + 1

    def _max_id(self) -> int:
        """The largest id given out: from the notes of the writes (an attempt
        that failed leaves a gap, never a second use), else from the id column
        of the whole table."""
        noted = [int(n.split(_MAX_ID)[1]) for n in self._claims() if _MAX_ID in n]
        return max(noted) if noted else int(self.read().agg(F.max(self.identity_col)).first()[0] or 0)

    # --------------------------------------------------------------- upsert

    def upsert(self, source: DataFrame, *, only_changed: bool = False, on_duplicate: str = "raise", order_by: Sequence[str] | None = None) -> dict[str, int]:
        """Merge ``source`` by the keys (see ``operators.upsert``); returns the
        counts INSERT and UPDATE and the number of buckets rewritten."""
        if on_duplicate not in ("raise", "latest"):
            raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
        if on_duplicate == "latest":
            if not order_by:
                raise ValueError("on_duplicate='latest' needs order_by")
            source = keep_latest(source, self.keys, order_by, self.case_insensitive, self.collation)
        if self.identity_col:
            source = source.drop(self.identity_col)
        version = self._next_version()
        with claims.claimed(self.spark, f"{self.path}/_claims/version={version}", f"version {version} of {self.path}"):
            claims.create(self.spark, f"{self.path}/_buckets={self.n_buckets}")
            staged, folder = self._staged(source)
            try:
                if on_duplicate == "raise":
                    assert_unique_keys(staged, self.keys, self.case_insensitive, self.collation)
                touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())  # n_buckets at most
                counts = self._write(staged, touched, version, only_changed) if touched else {"INSERT": 0, "UPDATE": 0}
            finally:
                remove_path(self.spark, folder)
            if not touched:
                claims.delete(self.spark, f"{self.path}/_claims/version={version}")
        return {**counts, "buckets": len(touched)}

    def _staged(self, source: DataFrame) -> tuple[DataFrame, str]:
        dealt = routed(source, self.bucket_by or self.keys, self.n_buckets, self.case_insensitive, self.collation)
        return stage_source(dealt, {f.name: f.dataType for f in self.schema})

    def plan(self, staged: DataFrame, touched: Sequence[int], only_changed: bool = False) -> tuple[DataFrame, DataFrame | None]:
        """The touched buckets after the merge: all rows, or (with ids to give
        out, or a small source) the old rows and apart from them the new ones."""
        target = self.read(touched, keep_bucket=True)
        how = dict(case_insensitive=self.case_insensitive, collation=self.collation, only_changed=only_changed)
        small = is_small(staged)
        if self.identity_col is None and not small:
            return merge_frames(target, staged, self.keys, strategy="shuffle", **how), None
        # the target's keys are unique: no more of them match than the source has
        return merge_parts(target, staged, self.keys, strategy="broadcast" if small else "auto", **how)

    def _write(self, staged: DataFrame, touched: Sequence[int], version: int, only_changed: bool) -> dict[str, int]:
        merged, inserts = self.plan(staged, touched, only_changed)
        if inserts is None:
            merged = merged.repartition(BUCKET)
        else:
            if self.identity_col:
                base = self._max_id()
                inserts = assign_surrogate_keys(inserts.drop(self.identity_col), self.identity_col, base=base)
                top = inserts.agg(F.max(self.identity_col)).first()[0]
                claims.create(self.spark, f"{self.path}/_claims/of={version},{_MAX_ID}{max(base, top or 0)}")
            # old rows stay in the tasks that read them; new ones are dealt by
            # bucket, so that a bucket does not get a file from every task
            merged = merged.unionByName(inserts.select(*merged.columns).repartition(BUCKET))
        merged, obs = merge_observation(merged, f"upsert-{version}")
        merged.drop(ACTION).write.mode("errorifexists").partitionBy(BUCKET).parquet(self._folder(version))
        got = obs.get
        return {k: int(got.get(k, 0)) for k in ("INSERT", "UPDATE")}

    # ----------------------------------------------------- changes, replace

    def moved(self, since: int, until: int | None = None) -> list[int]:
        """The buckets that another version (default: the newest) reads from
        other folders than version ``since``; 0 is the empty table."""
        old, new = self.layout(since) if since else {}, self.layout(until)
        return sorted(b for b, v in new.items() if old.get(b) != v)

    def changes(self, since: int, until: int | None = None, columns: Sequence[str] | None = None, keys: Sequence[str] | None = None) -> DataFrame:
        """The change set from one version to another (default: the newest),
        by ``keys`` (default: the table's). Only moved buckets are read."""
        moved = self.moved(since, until)
        before = self.read(moved, since) if since else self.read([])
        return change_set(before, self.read(moved, until), list(keys or self.keys), columns)

    def replace(self, groups: DataFrame, rows: DataFrame) -> dict[str, int]:
        """Put ``rows`` in the place of all rows of some ``groups`` (distinct
        values of the ``bucket_by`` columns, without NULLs). Only the groups'
        buckets are read and rewritten. A group without new rows goes; rows of
        groups that are not named are an error of the caller and not checked."""
        by = list(self.bucket_by or self.keys)
        version = self._next_version()
        with claims.claimed(self.spark, f"{self.path}/_claims/version={version}", f"version {version} of {self.path}"):
            claims.create(self.spark, f"{self.path}/_buckets={self.n_buckets}")
            gone, gone_folder = self._staged(groups.select(*by))
            staged, folder = self._staged(rows)
            try:
                touched = sorted({r[0] for df in (gone, staged) for r in df.select(BUCKET).distinct().collect()})
                counts = {"INSERT": 0, "UPDATE": 0}
                if touched:
                    now = self.read(touched, keep_bucket=True)
                    kept = lookup_join(now, gone.drop(ROW, BUCKET), by, by, "left_anti", collation=self.collation)
                    fresh = staged.drop(ROW)
                    if self.identity_col:
                        fresh = self._with_ids(fresh, now, version)
                    old_keys = now.select(*self.keys).withColumn("__lf_old", F.lit(True))
                    marked = lookup_join(fresh, old_keys, list(self.keys), list(self.keys), "left", collation=self.collation)
                    obs = Observation(f"replace-{version}")
                    marked = marked.observe(obs, F.count_if(F.col("__lf_old").isNull()).alias("INSERT"), F.count_if(F.col("__lf_old")).alias("UPDATE")).drop("__lf_old")
                    full = kept.unionByName(marked.repartition(BUCKET), allowMissingColumns=True)
                    full.select(*kept.columns).write.mode("errorifexists").partitionBy(BUCKET).parquet(self._folder(version))
                    counts = {k: int(v) for k, v in obs.get.items()}
                    # a bucket that lost all of its rows still has this version
                    for b in touched:
                        claims.make_folder(self.spark, f"{self._folder(version)}/{BUCKET}={b}")
            finally:
                remove_path(self.spark, folder)
                remove_path(self.spark, gone_folder)
            if not touched:
                claims.delete(self.spark, f"{self.path}/_claims/version={version}")
        return {**counts, "buckets": len(touched)}

    def _with_ids(self, rows: DataFrame, stored: DataFrame, version: int) -> DataFrame:
        """``rows`` with the ids of the stored rows of their keys, and new ids
        for the others."""
        keys, base = list(self.keys), self._max_id()
        known = lookup_join(rows.drop(self.identity_col), stored.select(*keys, self.identity_col), keys, keys, "left", collation=self.collation)
        new = assign_surrogate_keys(known.where(F.col(self.identity_col).isNull()).drop(self.identity_col), self.identity_col, base=base)
        top = new.agg(F.max(self.identity_col)).first()[0]
        claims.create(self.spark, f"{self.path}/_claims/of={version},{_MAX_ID}{max(base, top or 0)}")
        return known.where(F.col(self.identity_col).isNotNull()).unionByName(new)

    # -------------------------------------------------------------- cleanup

    def vacuum(self, keep_versions: int) -> int:
        """Delete the folders that none of the newest ``keep_versions``
        versions reads; returns their number."""
        versions = self.versions()
        live = {(v, b) for top in versions[-keep_versions:] for b, v in self.layout(top).items()}
        gone = 0
        for v in versions[:-keep_versions]:
            for name in claims.children(self.spark, self._folder(v), dirs=True):
                if name.startswith(f"{BUCKET}=") and (v, int(name.split("=")[1])) not in live:
                    claims.delete(self.spark, f"{self._folder(v)}/{name}")
                    gone += 1
        return gone
