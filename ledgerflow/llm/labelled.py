"""Bounded labelled samples for the trained classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: the fold of a row."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(parts))


def sample_labels(labels: DataFrame, label_col: str, rows: tuple[int, int], parts: int, held_out: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``rows[y]`` ids labelled ``y`` (0 and 1, as ``id``, ``label``)
    from all folds but ``held_out``: those whose id hashes lowest, so the
    sample is the same on every run. Null ids and labels are not drawn; an id
    that carries both labels counts as 1."""
    known = labels.where(F.col(id_col).isNotNull() & (remainder(id_col, parts) != held_out))
    known = known.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    drawn = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in enumerate(rows)]
    return drawn[0].unionByName(drawn[1]).groupBy("id").agg(F.max("label").alias("label"))


def sample_texts(docs: DataFrame, sample: DataFrame, max_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of the sampled documents; the sample (bounded by its
    size) is broadcast, so the documents are filtered where they lie.
    Documents longer than ``max_chars`` are not trained on: with its size that
    bounds what the driver holds."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    return texts.join(F.broadcast(sample), "id")


def collect_sorted(frame: DataFrame, *order: str) -> pd.DataFrame:
    """The bounded sample on the driver, in an order that no task decides."""
    return pd.DataFrame([r.asDict() for r in frame.collect()], columns=frame.columns).sort_values(list(order), ignore_index=True)
