"""One publication for all outputs of a load.

A run writes everything below a folder of its own and then one marker. Readers
go to the newest marked run, so accepted and rejected rows always come from the
same one, whenever a writer dies. The number of a run is claimed exclusively.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ledgerflow.plans import claims

_DONE = "_COMMITTED"


@dataclass
class Publication:
    spark: SparkSession
    path: str

    def __post_init__(self) -> None:
        self.path = self.path.rstrip("/")

    def runs(self) -> list[int]:
        """The committed runs, oldest first."""
        names = [n for n in claims.children(self.spark, self.path, dirs=True) if n.startswith("run=")]
        return sorted(int(n.split("=")[1]) for n in names if claims.exists(self.spark, f"{self.path}/{n}/{_DONE}"))

    def folder(self, run: int) -> str:
        return f"{self.path}/run={run}"

    def newest(self) -> str | None:
        """The folder of the newest committed run."""
        runs = self.runs()
        return self.folder(runs[-1]) if runs else None

    @contextmanager
    def new_run(self, keep: int | None = None):
        """The folder for a new run's outputs; committed when the block ends
        well, and then runs but the newest ``keep`` are deleted."""
        taken = [int(n.split("=")[1]) for n in claims.children(self.spark, f"{self.path}/_claims", dirs=False)]
        number = max([*taken, *self.runs()], default=0) + 1
        if not claims.create(self.spark, f"{self.path}/_claims/run={number}"):
            raise claims.ConcurrentWriteError(f"run {number} of {self.path} is another writer's")
        yield self.folder(number)
        claims.create(self.spark, f"{self.folder(number)}/{_DONE}")
        for old in self.runs()[:-keep] if keep else []:
            claims.delete(self.spark, self.folder(old))
