"""Installment schedule and payment status.

An invoice with ``n`` installments becomes ``n`` rows (``sequence`` +
``explode``: a narrow, per-row generator, no shuffle). Installment ``i`` is
due ``i - 1 + first_offset_months`` months after the issue date, clamped to
month end (``add_months``: Jan 31 + 1 month = Feb 28/29).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.joins import lookup_join


def installment_schedule(
    df: DataFrame,
    *,
    id_col: str,
    issue_date_col: str,
    total_col: str,
    count_col: str,
    due_col: str = "due_date",
    number_col: str = "installment_no",
    amount_col: str = "amount",
    first_offset_months: int = 0,
    split: str = "plain",
) -> DataFrame:
    """One row per installment: (id, due date, number, amount).

    ``split="plain"``: amount = total / n, exact decimal division
    (``decimal(10,2) / int`` gives ``decimal(21,13)``), no rounding.
    ``split="cents"``: amounts in whole cents, the remainder on the last
    installment, so the shares add up to the total exactly.

    A NULL, zero or negative count gives no rows (``sequence(1, 0)`` would
    give two); list such invoices with ``invalid_installment_counts``.
    """
    n = F.col(count_col)
    valid = n.isNotNull() & (n >= 1)
    seq = F.when(valid, F.sequence(F.lit(1), n.cast("int")))
    exploded = df.select(
        F.col(id_col), F.col(issue_date_col), F.col(total_col), n.alias("__lf_n"),
        F.explode(seq).alias(number_col),
    )
    i = F.col(number_col)
    total = F.col(total_col)
    if split == "plain":
        amount = F.try_divide(total, F.col("__lf_n"))
    elif split == "cents":
        cents = (total * F.lit(100)).cast("long")
        share = F.floor(cents / F.col("__lf_n")).cast("long")
        rest = cents - share * F.col("__lf_n")
        amount = ((share + F.when(i == F.col("__lf_n"), rest).otherwise(F.lit(0))) / F.lit(100)).cast(T.DecimalType(18, 2))
    else:
        raise ValueError(f"unknown split {split!r}")
    due = F.add_months(F.col(issue_date_col), i - F.lit(1) + F.lit(first_offset_months))
    return exploded.select(F.col(id_col), due.alias(due_col), i.alias(number_col), amount.alias(amount_col))


def invalid_installment_counts(df: DataFrame, count_col: str) -> DataFrame:
    """Invoices that get no schedule (count NULL or < 1)."""
    n = F.col(count_col)
    return df.filter(n.isNull() | (n < 1))


def payment_status(
    due: Column | str,
    as_of: date | str | Column | None = None,
    *,
    paid: str = "PAID",
    pending: str = "PENDING",
) -> Column:
    """``paid`` when due on or before ``as_of`` (default today), else ``pending``.

    A NULL due date is pending (F12, F13).
    """
    due = F.col(due) if isinstance(due, str) else due
    if as_of is None:
        ref = F.current_date()
    elif isinstance(as_of, Column):
        ref = as_of
    else:
        ref = F.lit(str(as_of)).cast("date")
    return F.when(due <= ref, F.lit(paid)).otherwise(F.lit(pending))


def refresh_status(df: DataFrame, due_col: str, status_col: str = "status", as_of=None, **labels) -> DataFrame:
    """Add or replace the status column (one projection)."""
    return df.withColumn(status_col, payment_status(due_col, as_of, **labels))


def schedule_with_pending(computed: DataFrame, pending: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of a fresh schedule with earlier pending rows; the fresh row wins.

    Pending rows whose key also occurs in ``computed`` are dropped first (an
    anti join), so the union never holds a key twice and a later keyed
    upsert stays unambiguous (U0b, trap 9).
    """
    kept = lookup_join(pending, computed.select(*keys), list(keys), list(keys), "left_anti")
    return computed.unionByName(kept.select(*computed.columns))
