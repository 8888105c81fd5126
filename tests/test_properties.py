"""Property tests: validate and upsert against brute-force Python models."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators import rule_duplicated, rule_expr, rule_in_lookup, rule_not_null, upsert_snapshot, validate

ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from(["a", "b", "x"]))), max_size=25)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=ROWS, dim=st.lists(st.integers(0, 5), max_size=4), salted=st.booleans())
def test_validate_matches_model(spark, rows, dim, salted):
    df = spark.createDataFrame(rows, "k int, v string")
    d = spark.createDataFrame([(x,) for x in dim], "k int")
    rules = [
        rule_duplicated(),
        rule_not_null(["v"]),
        rule_expr(F.col("v") == "x", "is x"),
        rule_in_lookup("k", d, "k", "no k", broadcast=False if salted else None, salt_hot_keys=2 if salted else None),
    ]
    v = validate(df, rules)
    counts = Counter(rows)
    model_rej, model_acc = {}, set()
    for row, n in counts.items():
        k, val = row
        fired = [("duplicated", n > 1), ("null column(s)", val is None), ("is x", val == "x"), ("no k", k is None or k not in dim)]
        labels = [lab for lab, f in fired if f]
        if labels:
            model_rej[row] = ", ".join(labels)
        if not any(f for lab, f in fired[1:]):
            model_acc.add(row)
    assert {(r.k, r.v): r.inconsistencies for r in v.rejected.collect()} == model_rej
    assert {(r.k, r.v) for r in v.accepted.collect()} == model_acc


KEYED = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.integers(0, 3)), max_size=15)


@SETTINGS
@given(target=KEYED, source=KEYED, strategy=st.sampled_from(["shuffle", "broadcast", "auto"]))
def test_upsert_matches_model(spark, target, source, strategy):
    # keep source keys unique (non-NULL), as the default mode requires
    seen, src = set(), []
    for k, v in source:
        if k is None or k not in seen:
            src.append((k, v))
            if k is not None:
                seen.add(k)
    t = spark.createDataFrame(target, "k int, v int")
    s = spark.createDataFrame(src, "k int, v int")
    res = upsert_snapshot(t, s, ["k"], strategy=strategy)
    src_keys = {k for k, _ in src if k is not None}
    # every matched target row takes its source row's values (MERGE updates
    # each matching target row); unmatched source rows are inserted
    src_by_key = {k: v for k, v in src if k is not None}
    tgt_keys_all = {k for k, _ in target if k is not None}
    model = [(k, src_by_key[k]) if k is not None and k in src_keys else (k, v) for k, v in target]
    model += [(k, v) for k, v in src if k is None or k not in tgt_keys_all]
    key = lambda t: (t[0] is None, t[0] or 0, t[1])
    assert sorted((tuple(r) for r in res.state.collect()), key=key) == sorted(model, key=key)
    tgt_keys = {k for k, _ in target if k is not None}
    matched_rows = sum(1 for k, _ in target if k is not None and k in src_keys)
    expect = Counter()
    for k, _ in src:
        if k is not None and k in tgt_keys:
            expect["UPDATE"] += sum(1 for tk, _ in target if tk == k)
        else:
            expect["INSERT"] += 1
    assert {r.action: r.cnt for r in res.stats.collect()} == {a: n for a, n in expect.items() if n}
    assert matched_rows == expect["UPDATE"]


def _add_months(d, m):
    import calendar
    import datetime as dt

    y, mo = divmod(d.month - 1 + m, 12)
    y += d.year
    last = calendar.monthrange(y, mo + 1)[1]
    return dt.date(y, mo + 1, min(d.day, last))


@SETTINGS
@given(
    invoices=st.lists(
        st.tuples(st.dates(min_value=__import__("datetime").date(2000, 1, 1), max_value=__import__("datetime").date(2030, 12, 31)),
                  st.integers(1, 10_000_000), st.one_of(st.none(), st.integers(-1, 12))),
        max_size=8),
)
def test_schedule_matches_model(spark, invoices):
    from decimal import Decimal

    from ledgerflow.operators import installment_schedule

    rows = [(i, d, Decimal(c) / 100, n) for i, (d, c, n) in enumerate(invoices)]
    df = spark.createDataFrame(rows, "id int, d date, total decimal(10,2), n int")
    kw = dict(id_col="id", issue_date_col="d", total_col="total", count_col="n")
    plain = {(r.id, r.installment_no): (r.due_date, r.amount) for r in installment_schedule(df, **kw).collect()}
    cents = {(r.id, r.installment_no): r.amount for r in installment_schedule(df, split="cents", **kw).collect()}
    expected_keys = {(i, k) for i, _, _, n in rows if n is not None and n >= 1 for k in range(1, n + 1)}
    assert set(plain) == expected_keys == set(cents)
    for i, d, total, n in rows:
        if n is None or n < 1:
            continue
        assert sum(cents[(i, k)] for k in range(1, n + 1)) == total
        assert all(cents[(i, k)] == cents[(i, 1)] for k in range(1, n))
        for k in range(1, n + 1):
            due, amount = plain[(i, k)]
            assert due == _add_months(d, k - 1)
            assert abs(amount - total / n) < Decimal("1e-12")
