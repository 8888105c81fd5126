"""Column-level functions: all are JVM-side Column expressions (codegen)."""

from ledgerflow.functions.clean import (
    canonicalize,
    cast_columns,
    concat_labels,
    drop_nulls,
    empty_as_null,
    fill_null,
    parse_date,
    to_decimal,
    trim_strings,
    try_int,
    upper_trim,
    with_row_ids,
)
from ledgerflow.functions.checks import cnpj_is_valid, digits_only, with_cnpj_valid

__all__ = [
    "canonicalize",
    "cast_columns",
    "concat_labels",
    "drop_nulls",
    "empty_as_null",
    "fill_null",
    "parse_date",
    "to_decimal",
    "trim_strings",
    "try_int",
    "upper_trim",
    "with_row_ids",
    "cnpj_is_valid",
    "digits_only",
    "with_cnpj_valid",
]
