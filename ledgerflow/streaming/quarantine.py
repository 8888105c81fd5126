"""Incremental quarantine of purchase files as they land in a folder.

The file source picks up new CSV files; every micro-batch runs the same
one-pass ``validate`` as the batch job and writes its accepted and rejected
rows into folders named after the batch id. A batch that is re-run after a
failure overwrites its own folders, so output is exactly-once; the stream's
progress lives in ``checkpoint_dir`` (a shared folder).

Duplicates are detected across micro-batches and restarts: each batch is a
load of ``plans.seen.SeenRows`` under its number, recorded after its outputs.
A row is accepted by the first batch that has it and reported once, by the
batch that brings the second copy. ``across_batches=False`` looks at each
batch alone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.plans.jobs import PURCHASE_COLUMNS, TERM_ALIASES, compute_purchases_quarantine
from ledgerflow.plans.seen import SeenRows
from ledgerflow.sources import string_schema, write_csv, write_parquet


def start_quarantine_stream(
    spark: SparkSession,
    source_dir: str,
    postal_codes: DataFrame,
    out_dir: str,
    *,
    checkpoint_dir: str | None = None,
    term_aliases: Mapping[str, str] = TERM_ALIASES,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    processing_time: str = "1 minute",
    across_batches: bool = True,
) -> StreamingQuery:
    """Start the stream; outputs go to ``out_dir/{staging,rejected}/batch=N``."""
    out = out_dir.rstrip("/")
    reader = spark.readStream.schema(string_schema(PURCHASE_COLUMNS)).option("header", "true").option("sep", ",")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    purchases = reader.csv(source_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        seen = SeenRows(batch.sparkSession, f"{out}/seen", PURCHASE_COLUMNS) if across_batches else None
        v = compute_purchases_quarantine(batch, postal_codes, term_aliases, seen=seen, load=f"batch-{batch_id}")
        v = v.materialize(f"{out}/work/batch={batch_id}")
        write_parquet(v.accepted, f"{out}/staging/batch={batch_id}")
        write_csv(v.rejected, f"{out}/rejected/batch={batch_id}", sep=";", header=True)
        if seen is not None:
            v.record()

    writer = purchases.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_dir or f"{out}/_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
