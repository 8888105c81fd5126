"""Cleaning and typing expressions (F1-F16).

All helpers build Column expressions or a single ``select`` so Catalyst
sees one projection (not a chain of ``withColumn`` calls) and the work stays
inside whole-stage codegen. Parsing uses the ``try_*`` forms: malformed
input becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_trim(c: ColumnOrName) -> Column:
    """``upper(trim(c))`` (F2)."""
    return F.upper(F.trim(_col(c)))


def empty_as_null(c: ColumnOrName) -> Column:
    """``''`` → NULL (a trimmed whitespace-only field is ``''``, not NULL)."""
    c = _col(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def trim_strings(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    *,
    upper: Iterable[str] = (),
    empty_to_null: bool = False,
) -> DataFrame:
    """Trim every string column (or ``columns``) in one projection (F1).

    Whitespace-only values become ``''`` unless ``empty_to_null``. Columns in
    ``upper`` are also upper-cased (F2). Order and names are kept.
    """
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    wanted = set(string_cols if columns is None else columns)
    upper = set(upper)
    out = []
    for name in df.columns:
        c = F.col(name)
        if name in wanted:
            c = F.trim(c)
            if name in upper:
                c = F.upper(c)
            if empty_to_null:
                c = empty_as_null(c)
            c = c.alias(name)
        out.append(c)
    return df.select(*out)


def canonicalize(
    c: ColumnOrName,
    mapping: Mapping[str, str],
    *,
    invalid_suffix: str | None = " (invalid)",
) -> Column:
    """Map known values to their canonical form.

    Unknown non-null values keep their text plus ``invalid_suffix`` (string
    concatenation, F4) or become NULL when the suffix is None. NULL stays NULL;
    a canonical value of None makes NULL. One CASE expression, whatever the
    number of entries; a mapping of thousands belongs in a dimension table
    (``operators.entities.Lookup``).
    """
    c = _col(c)
    if invalid_suffix is None:
        fallback = F.lit(None).cast("string")
    else:
        fallback = F.concat(c, F.lit(invalid_suffix))
    expr = None
    for raw, canon in mapping.items():
        expr = (F.when if expr is None else expr.when)(c == F.lit(raw), F.lit(canon).cast("string"))
    return fallback if expr is None else expr.otherwise(fallback)


def fill_null(df: DataFrame, value: str | int | float, subset: Sequence[str]) -> DataFrame:
    """Replace NULL with ``value`` in ``subset``."""
    return df.fillna(value, subset=list(subset))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``subset`` (default: all columns)."""
    return df.dropna(how="any", subset=list(subset) if subset is not None else None)


def try_int(c: ColumnOrName) -> Column:
    """String → int; malformed or out of range → NULL."""
    return _col(c).try_cast(T.IntegerType())


def to_decimal(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """→ decimal(precision, scale), keeping cents; malformed → NULL."""
    return _col(c).try_cast(T.DecimalType(precision, scale))


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """String → date with a pattern; malformed → NULL (F8)."""
    return F.try_to_date(_col(c), fmt)


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType], date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Cast named columns to target types in one projection (``try`` semantics).

    Dates use ``date_format`` for strings. Used before any write so values
    match the target schema.
    """
    resolved = {}
    for name, dtype in types.items():
        if isinstance(dtype, str):
            dtype = T.DataType.fromDDL(dtype)
        resolved[name] = dtype
    out = []
    for f in df.schema.fields:
        if f.name not in resolved:
            out.append(F.col(f.name))
            continue
        dtype = resolved[f.name]
        if isinstance(dtype, T.DateType) and isinstance(f.dataType, T.StringType):
            out.append(parse_date(f.name, date_format).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(dtype).alias(f.name))
    return df.select(*out)


def concat_labels(flags: Sequence[tuple[Column, str]], sep: str = ", ") -> Column:
    """Join the labels whose flag is true, in the given order.

    ``concat_ws`` skips NULLs, so each label is ``when(flag, label)``.
    """
    return F.concat_ws(sep, *[F.when(flag, F.lit(label)) for flag, label in flags])


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique (not consecutive) 64-bit row id (F15), no shuffle.

    Ids are only stable while the input partitions are: recomputation after a
    shuffle may renumber rows. Persist or checkpoint before relying on them
    across actions; for consecutive ids use ``operators.keys.assign_surrogate_keys``.
    """
    return df.withColumn(name, F.monotonically_increasing_id())
