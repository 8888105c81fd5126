"""Entity extraction and business-key resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerflow.operators.joins import lookup_join

ColumnOrName = Column | str


def extract_entity(df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct projection with renamed columns (D5: select → distinct → rename)."""
    out = df.select(*columns).distinct()
    return out.withColumnsRenamed(dict(renames)) if renames else out


def union_distinct(frames: Sequence[DataFrame], distinct: bool = True) -> DataFrame:
    """UNION (by column name) of ``frames``; ``distinct=False`` keeps duplicates."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct() if distinct else out


@dataclass
class Lookup:
    """Resolve ``left_on`` against ``dim[dim_key]`` and take dimension columns.

    ``take`` maps dimension columns to output names. ``how`` is "inner"
    (unmatched rows dropped) or "left" (kept with NULLs). ``casefold``
    compares ``upper(left_on)`` with the (already upper-case) dimension key,
    ``collation`` compares both as a Spark collation does.
    """

    dim: DataFrame
    left_on: ColumnOrName
    dim_key: str
    take: Mapping[str, str] = field(default_factory=dict)
    how: str = "inner"
    casefold: bool = False
    broadcast: bool | None = None  # this and the next: see operators.joins.lookup_join
    salt_hot_keys: int | None = None
    collation: str | None = None


def resolve_keys(df: DataFrame, lookups: Sequence[Lookup], observe: Observation | None = None) -> DataFrame:
    """Attach dimension ids for business keys.

    With ``observe``, inner lookups run as left joins plus one filter on the
    match markers (the same rows as inner joins), and the Observation gets
    ``unmatched_<i>``: rows lookup ``i`` dropped, counted by the first action
    on the result with no extra pass. That action must read all of it (a
    write, a checkpoint), not a ``limit``.
    """
    out = df
    markers: list[tuple[int, str]] = []
    for i, lk in enumerate(lookups):
        key = F.col(lk.left_on) if isinstance(lk.left_on, str) else lk.left_on
        if lk.casefold:
            key = F.upper(key)
        marker = f"__lf_m{i}"
        right = lk.dim.select(F.col(lk.dim_key), *[F.col(a).alias(b) for a, b in lk.take.items()], F.lit(True).alias(marker))
        how = lk.how.lower()
        if how not in ("inner", "left"):
            raise ValueError(f"unsupported lookup type {lk.how!r}")
        if how == "inner" and observe is None:
            out = lookup_join(out, right, [key], [lk.dim_key], "inner", broadcast=lk.broadcast,
                              salt_hot_keys=lk.salt_hot_keys, collation=lk.collation).drop(marker)
            continue
        out = lookup_join(out, right, [key], [lk.dim_key], "left", broadcast=lk.broadcast,
                          salt_hot_keys=lk.salt_hot_keys, collation=lk.collation)
        if how == "inner":
            markers.append((i, marker))
        else:
            out = out.drop(marker)
    if markers:
        out = out.observe(observe, *[F.count_if(F.col(m).isNull()).alias(f"unmatched_{i}") for i, m in markers])
        keep = F.lit(True)
        for _, m in markers:
            keep = keep & F.col(m).isNotNull()
        out = out.filter(keep).drop(*[m for _, m in markers])
    return out
