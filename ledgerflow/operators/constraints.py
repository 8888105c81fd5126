"""Table constraints checked as Spark jobs.

Spark does not enforce PRIMARY KEY / FOREIGN KEY / NOT NULL / length
bounds, so each is a query that lists the violations.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.bitmaps import mark_members, stage_bitmaps
from ledgerflow.operators.joins import collated, lookup_join


def check_unique(df: DataFrame, keys: Sequence[str], count_col: str = "n", collation: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their count (X1); with
    ``collation``, text keys that it holds for equal are one key, shown in the
    spelling that is least in bytes.

    Partial aggregation: a key repeated everywhere reaches the shuffle once
    per input partition.
    """
    counted = F.count(F.lit(1)).alias(count_col)
    if collation is None:
        return df.groupBy(*keys).agg(counted).where(F.col(count_col) > 1)
    text = {c for c, t in df.select(*keys).dtypes if t.startswith("string")}
    groups = df.groupBy(*[(collated(F.col(k), collation) if k in text else F.col(k)).alias(f"__lf_{k}") for k in keys])
    return groups.agg(*[F.min(k).alias(k) for k in keys], counted).where(F.col(count_col) > 1).select(*keys, count_col)


def check_references(
    child: DataFrame,
    fk: Sequence[str],
    parent: DataFrame,
    pk: Sequence[str],
    *,
    broadcast: bool | None = None,
    collation: str | None = None,
    bitmap: bool = False,
) -> DataFrame:
    """Child rows whose (all non-NULL) foreign key has no parent row.

    ``bitmap=True`` (one integer key): the parent's keys become one bit each
    and the child is not shuffled (``operators.bitmaps``). ``collation``
    compares text keys as a Spark collation does.
    """
    set_fk = F.lit(True)
    for c in fk:
        set_fk = set_fk & F.col(c).isNotNull()
    if bitmap:
        if len(fk) != 1:
            raise ValueError("bitmap is for one integer key")
        bitmaps, fits = stage_bitmaps(parent, pk[0])
        marked = mark_members(child.where(set_fk), F.col(fk[0]), bitmaps, "__lf_known", broadcast=fits or None)
        return marked.where(~F.col("__lf_known")).drop("__lf_known")
    return lookup_join(child.where(set_fk), parent.select(*pk), list(fk), list(pk), "left_anti", broadcast=broadcast, collation=collation)


def check_not_null(df: DataFrame, columns: Iterable[str], count_col: str = "n", by_column: bool = False) -> DataFrame:
    """One row: ``n`` = rows with a NULL in any of ``columns``.

    ``by_column`` adds ``<count_col>_<column>`` per column, same single pass.
    """
    cols = list(columns)
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    aggs = [F.count_if(any_null).alias(count_col)]
    if by_column:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{count_col}_{c}") for c in cols]
    return df.agg(*aggs)


def check_length(df: DataFrame, column: str, max_length: int, keep: Sequence[str] = (), length_col: str = "len") -> DataFrame:
    """Rows whose ``column`` is longer than ``max_length`` characters."""
    n = F.length(F.col(column))
    return df.where(n > max_length).select(*keep, n.alias(length_col))
