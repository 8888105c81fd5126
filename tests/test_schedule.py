import datetime as dt
from decimal import Decimal

from ledgerflow.operators import installment_schedule, invalid_installment_counts, refresh_status, schedule_with_pending


def invoices(spark, rows):
    return spark.createDataFrame(rows, "id int, d date, total decimal(10,2), n int")


def sched(df, **kw):
    return installment_schedule(df, id_col="id", issue_date_col="d", total_col="total", count_col="n", **kw)


def test_month_end_clamp_and_amounts(spark):
    df = invoices(spark, [(1, dt.date(2023, 1, 31), Decimal("100.00"), 3)])
    rows = sched(df).orderBy("installment_no").collect()
    assert [r.due_date for r in rows] == [dt.date(2023, 1, 31), dt.date(2023, 2, 28), dt.date(2023, 3, 31)]
    assert [r.installment_no for r in rows] == [1, 2, 3]
    assert dict(sched(df).dtypes)["amount"] == "decimal(21,13)"
    assert sum(r.amount for r in rows) - Decimal("100") < Decimal("1e-9")


def test_zero_and_null_counts_give_no_rows(spark):
    df = invoices(spark, [(1, dt.date(2023, 1, 1), Decimal("10.00"), 0), (2, dt.date(2023, 1, 1), Decimal("10.00"), None),
                          (3, dt.date(2023, 1, 1), Decimal("10.00"), -2)])
    assert sched(df).count() == 0
    assert sorted(r.id for r in invalid_installment_counts(df, "n").collect()) == [1, 2, 3]


def test_cents_split_uneven(spark):
    df = invoices(spark, [(1, dt.date(2023, 1, 1), Decimal("100.01"), 3)])
    rows = sched(df, split="cents").orderBy("installment_no").collect()
    assert [r.amount for r in rows] == [Decimal("33.33"), Decimal("33.33"), Decimal("33.35")]
    plain = sched(df).collect()
    assert all(r.amount == Decimal("100.01") / 3 or abs(r.amount - Decimal("33.3366666666667")) < Decimal("1e-12") for r in plain)


def test_first_offset_and_status(spark):
    df = invoices(spark, [(1, dt.date(2023, 1, 15), Decimal("20.00"), 2)])
    s = refresh_status(sched(df, first_offset_months=1), "due_date", "status", as_of="2023-02-15")
    rows = s.orderBy("installment_no").collect()
    assert [(r.due_date, r.status) for r in rows] == [(dt.date(2023, 2, 15), "PAID"), (dt.date(2023, 3, 15), "PENDING")]
    nulls = spark.createDataFrame([(None,)], "due_date date")
    assert refresh_status(nulls, "due_date", as_of="2023-01-01").first().status == "PENDING"


def test_rerun_with_pending_rows_computed_wins(spark):
    computed = spark.createDataFrame([(1, 1, 5.0), (1, 2, 5.0)], "id int, no int, amount double")
    pending = spark.createDataFrame([(1, 2, 9.0), (2, 1, 7.0), (None, 1, 1.0)], "id int, no int, amount double")
    rows = sorted(schedule_with_pending(computed, pending, ["id", "no"]).collect(), key=lambda r: (r.id is None, r.id or 0, r.no))
    assert [tuple(r) for r in rows] == [(1, 1, 5.0), (1, 2, 5.0), (2, 1, 7.0), (None, 1, 1.0)]
