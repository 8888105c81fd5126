"""Distributed file sinks (K1, K2).

The reference converted to pandas on the driver before writing; here every
executor writes its own partitions. Row counts are gathered with
``DataFrame.observe`` during the write, so no second action re-runs the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _observed(df: DataFrame, name: str | None) -> tuple[DataFrame, Observation | None]:
    if name is None:
        return df, None
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    observe: str | None = None,
) -> Observation | None:
    """Write Parquet; returns an Observation with ``rows`` when ``observe`` is set."""
    df, obs = _observed(df, observe)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return obs


def write_csv(
    df: DataFrame,
    path: str,
    *,
    sep: str = ";",
    header: bool = True,
    mode: str = "overwrite",
    observe: str | None = None,
    **options: str,
) -> Observation | None:
    """Write delimited text (one file per partition) with a header line."""
    df, obs = _observed(df, observe)
    writer = df.write.mode(mode).option("sep", sep).option("header", str(header).lower())
    # keep values exactly as they are (the writer trims by default)
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.csv(path)
    return obs
