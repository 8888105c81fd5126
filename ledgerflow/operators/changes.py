"""Row digests and change sets between two states of a table (D8, D1e)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.joins import any_null, null_salt

CHANGE = "_change"


def row_digest(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of the values of ``columns``, as two longs. Which of them are
    NULL counts too (Spark's hashes skip NULLs, so (NULL, 'a') and ('a', NULL)
    would be alike)."""
    if not columns:
        return F.lit(0).cast("long"), F.lit(0).cast("long")
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    values = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(nulls, *values), F.xxhash64(F.lit("second"), *reversed(values), nulls)


def change_set(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(keys, ``_change``) of every row that differs between two states of a
    table: "insert", "update" or "delete".

    Each side is reduced to its key and the digest of ``columns`` (default: all
    other columns of ``new``) before the one join, so no row's values are
    shuffled. Keys are unique on each side; a row with a NULL in its key is
    nothing's successor: such rows are inserts and deletes.
    """
    columns = list(columns) if columns is not None else [c for c in new.columns if c not in keys]
    sides = []
    for name, df, sign in (("o", old, 1), ("n", new, 2)):
        a, b = row_digest(columns)
        # rows with a NULL key never meet: odd salts on one side, even on the other
        salt = F.when(any_null(keys), 2 * null_salt(keys) + sign).otherwise(F.lit(0))
        sides.append(df.select(*[F.col(f"`{k}`").alias(f"__lf_{name}{i}") for i, k in enumerate(keys)], salt.alias(f"__lf_{name}salt"), a.alias(f"__lf_{name}a"), b.alias(f"__lf_{name}b")))
    on = F.col("__lf_osalt") == F.col("__lf_nsalt")
    for i in range(len(keys)):
        on = on & (F.col(f"__lf_o{i}") == F.col(f"__lf_n{i}"))
    both = sides[0].join(sides[1], on, "full_outer")
    same = (F.col("__lf_oa") == F.col("__lf_na")) & (F.col("__lf_ob") == F.col("__lf_nb"))
    kind = F.when(F.col("__lf_osalt").isNull(), "insert").when(F.col("__lf_nsalt").isNull(), "delete").when(~same, "update")
    out = both.select(*[F.coalesce(f"__lf_n{i}", f"__lf_o{i}").alias(k) for i, k in enumerate(keys)], kind.alias(CHANGE))
    return out.where(F.col(CHANGE).isNotNull())
