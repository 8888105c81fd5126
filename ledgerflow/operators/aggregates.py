"""Aggregations (A3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_labels(df: DataFrame, group_cols: Sequence[str], label_col: str, out_col: str, sep: str = ", ") -> DataFrame:
    """Distinct labels per group, sorted, joined with ``sep`` (A3).

    ``collect_set`` merges map-side, so a group's state is bounded by the
    number of distinct labels, not by its row count: meant for label columns
    of a fixed vocabulary (rule names, event types), not for free text.
    """
    return df.groupBy(*group_cols).agg(F.concat_ws(sep, F.array_sort(F.collect_set(F.col(label_col)))).alias(out_col))
