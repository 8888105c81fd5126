"""A kept table of what every run did (K8, A4).

One row a run, step and metric: the counts that the step's writes observed
(``DataFrame.observe``: Spark's listener delivers them when the write ends, no
second pass counts anything) and its seconds. A step's rows are one folder
(``run=R/step=S``), so recording the same step of the same run again replaces
them, and a step counts as done when its folder is complete.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.plans import claims

_ROWS = T.StructType().add("metric", "string").add("value", "long").add("seconds", "double")
_READ = T.StructType([T.StructField("run", T.StringType()), T.StructField("step", T.StringType()), *_ROWS.fields])


@dataclass
class RunHistory:
    spark: SparkSession
    path: str

    def _folder(self, run: str, step: str) -> str:
        for name in (run, step):
            if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
                raise ValueError(f"not a name for a run or step: {name!r}")
        return f"{self.path.rstrip('/')}/run={run}/step={step}"

    def record(self, run: str, step: str, counts: Mapping[str, int], seconds: float = 0.0) -> None:
        rows = [(k, int(v), float(seconds)) for k, v in counts.items()] or [(None, None, float(seconds))]
        self.spark.createDataFrame(rows, _ROWS).coalesce(1).write.mode("overwrite").parquet(self._folder(run, step))

    def counts(self, run: str, step: str) -> dict[str, int] | None:
        """What the step recorded; None unless it is done."""
        folder = self._folder(run, step)
        if not claims.exists(self.spark, f"{folder}/_SUCCESS"):
            return None
        return {r.metric: r.value for r in self.spark.read.schema(_ROWS).parquet(folder).collect() if r.metric is not None}

    def read(self) -> DataFrame:
        """(run, step, metric, value, seconds) of all runs."""
        if not claims.children(self.spark, self.path, dirs=True):
            return self.spark.createDataFrame([], _READ)
        return self.spark.read.schema(_READ).parquet(self.path).select(*_READ.fieldNames()).where(F.col("metric").isNotNull())

    def step(self, run: str, step: str, work: Callable[[], Mapping[str, int]]) -> dict[str, int]:
        """Do ``work`` and record its counts; a step of the run that is done
        already is not done again."""
        done = self.counts(run, step)
        if done is not None:
            return done
        began = time.monotonic()
        counts = dict(work())
        self.record(run, step, counts, time.monotonic() - began)
        return counts
