"""Duplicates across loads (D1e, A1): a kept table of row digests.

The state of a feed is a table of the distinct rows it has delivered so far:
a 128-bit digest and the number of copies, partitioned by load and by digest
prefix (``load=L/bucket=B``). A load joins its distinct rows to the earlier
loads' counts, reading only the buckets that its own digests fall into, so a
micro-batch of a hundred rows opens at most a hundred of them.

A load is recorded under its own name, and what is recorded under that name is
left out when it is run again: a load that died half-way, or a micro-batch that
Spark repeats, gives the same result and never becomes its own duplicate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.changes import row_digest
from ledgerflow.plans import claims
from ledgerflow.session import scratch_path

_STATE = T.StructType().add("d1", "long").add("d2", "long").add("n", "long")
_READ = T.StructType([*_STATE.fields, T.StructField("load", T.StringType()), T.StructField("bucket", T.IntegerType())])
#: The load that ``compact`` writes.
_BASE = "base-"


@dataclass
class SeenRows:
    """``columns`` are those that make two rows copies of each other."""

    spark: SparkSession
    path: str
    columns: Sequence[str]
    n_buckets: int = 256

    def __post_init__(self) -> None:
        self.path = self.path.rstrip("/")

    def _bucket(self, d1: Column) -> Column:
        return F.pmod(d1, F.lit(self.n_buckets)).cast("int")

    def loads(self) -> list[str]:
        """The complete loads whose folders count: the newest base, and the
        loads that it does not include."""
        names = [n.split("=", 1)[1] for n in claims.children(self.spark, self.path, dirs=True) if n.startswith("load=")]
        done = [n for n in names if claims.exists(self.spark, f"{self.path}/load={n}/_SUCCESS")]
        bases = sorted((n for n in done if n.startswith(_BASE)), key=lambda n: int(n[len(_BASE):]))
        if not bases:
            return sorted(done)
        inside = set(claims.children(self.spark, f"{self.path}/_includes/{bases[-1]}", dirs=False))
        return [bases[-1], *sorted(n for n in done if not n.startswith(_BASE) and n not in inside)]

    def read(self, loads: Sequence[str], buckets: Sequence[int] | None = None) -> DataFrame:
        """(d1, d2, n) of some loads and buckets, one row a digest and load."""
        want = None if buckets is None else {f"bucket={b}" for b in buckets}
        paths = [
            f"{self.path}/load={n}/{c}" for n in loads for c in claims.children(self.spark, f"{self.path}/load={n}", dirs=True)
            if c.startswith("bucket=") and (want is None or c in want)
        ]
        if not paths:
            return self.spark.createDataFrame([], _STATE)
        return self.spark.read.schema(_READ).option("basePath", self.path).parquet(*paths).select("d1", "d2", "n")

    def with_prior(self, rows: DataFrame, load: str, prior_col: str) -> tuple[DataFrame, str]:
        """``rows`` (distinct in ``columns``), written with their digests, and
        the number of copies that other loads had; and the folder they are
        written to. The written digests say which buckets to read."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", load) or load.startswith(_BASE):
            raise ValueError(f"not a name for a load: {load!r}")
        loads = self.loads()
        if loads and loads[0].startswith(_BASE) and load in claims.children(self.spark, f"{self.path}/_includes/{loads[0]}", dirs=False):
            raise ValueError(f"load {load!r} has been compacted and cannot be run again")
        loads = [n for n in loads if n != load]
        d1, d2 = row_digest(self.columns)
        marked = rows.withColumn("__lf_d1", d1).withColumn("__lf_d2", d2)
        folder = scratch_path(self.spark, "load-rows")
        marked.write.parquet(folder)
        marked = self.spark.read.schema(marked.schema).parquet(folder)
        touched = [r[0] for r in marked.select(self._bucket(F.col("__lf_d1"))).distinct().collect()]  # n_buckets at most
        prior = self.read(loads, touched).groupBy("d1", "d2").agg(F.sum("n").alias(prior_col))
        on = (F.col("__lf_d1") == F.col("d1")) & (F.col("__lf_d2") == F.col("d2"))
        joined = marked.join(prior, on, "left").drop("d1", "d2").withColumn(prior_col, F.coalesce(prior_col, F.lit(0).cast("long")))
        return joined, folder

    def record(self, digests: DataFrame, load: str) -> None:
        """Keep (``__lf_d1``, ``__lf_d2``, n) under the load's name; what a
        failed run of the same load left there is replaced."""
        out = digests.select(F.col("__lf_d1").alias("d1"), F.col("__lf_d2").alias("d2"), F.col("n").cast("long").alias("n"))
        out = out.withColumn("bucket", self._bucket(F.col("d1"))).repartition("bucket")
        out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/load={load}")

    def compact(self) -> str | None:
        """Write all loads so far as one base, so that a feed of many small
        loads does not become as many small files. Until the base is complete
        readers see the single loads."""
        loads = self.loads()
        if len(loads) < 2:
            return None
        last = int(loads[0][len(_BASE):]) if loads[0].startswith(_BASE) else 0
        base = f"{_BASE}{last + 1}"
        old = claims.children(self.spark, f"{self.path}/_includes/{loads[0]}", dirs=False) if last else []
        claims.delete(self.spark, f"{self.path}/_includes/{base}")  # of a failed attempt
        for n in [*old, *(n for n in loads if not n.startswith(_BASE))]:
            claims.create(self.spark, f"{self.path}/_includes/{base}/{n}")
        rows = self.read(loads).groupBy("d1", "d2").agg(F.sum("n").alias("n"))
        rows.withColumn("bucket", self._bucket(F.col("d1"))).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/load={base}")
        for n in loads:
            claims.delete(self.spark, f"{self.path}/load={n}")
        return base
