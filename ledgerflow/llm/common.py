"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path

#: The six ASCII white-space characters, ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
_SHIPPED: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage on storage that every executor sees: a lost executor
    costs only its running tasks, and later passes do not repeat the work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (``--py-files`` does the same
    for a submitted job); once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ledgerflow-py-")) / "ledgerflow.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, text_hash): each row of ``docs`` packed whole, so that no
    column of it can clash with an operator's own, and what identifies it."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"))


def unpacked(rows: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The packed columns again; those in ``new`` replaced, or added last."""
    old = [new.get(c, F.col("row").getField(c)).alias(c) for c in columns]
    return rows.select(*old, *(v.alias(k) for k, v in new.items() if k not in columns))
