from pyspark.sql import functions as F

from fixtures import COLUMNS, invoice, make_cnpj, supplier
from ledgerflow.operators import rule_duplicated, rule_expr, rule_in_domain, rule_in_lookup, rule_not_null, validate
from ledgerflow.plans import jobs


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], ", ".join(f"{c} string" for c in COLUMNS))


def postal(spark, codes):
    return spark.createDataFrame([(c,) for c in codes], "CEP int")


def reasons(spark, rows, codes=(12605010,)):
    v = jobs.compute_purchases_quarantine(frame(spark, rows), postal(spark, codes))
    return {r["NUMERO_NF"]: r["inconsistencies"] for r in v.rejected.collect()}, {r["NUMERO_NF"] for r in v.accepted.collect()}


def test_unknown_term_and_postal_codes(spark):
    s = supplier(1)  # CEP 12605010
    rows = [
        invoice(s, 1, "Boleto 45 dias"),               # unknown non-null term
        invoice(s, 2, "30 dias") | {"CEP": "99999999"},  # unknown postal code
        invoice(s, 3, "30 dias") | {"CEP": None},        # NULL postal code: null rule and lookup
        invoice(s, 4, "30 dias") | {"CEP": "12A05010"},  # not a number
        invoice(s, 5, " a VISTA "),                      # accepted spelling
    ]
    bad, ok = reasons(spark, rows)
    assert bad["1"] == "invalid payment condition"
    assert bad["2"] == "invalid CEP"
    assert bad["3"] == "null column(s), invalid CEP"
    assert bad["4"] == "invalid CEP"
    assert ok == {"5"}


def test_whitespace_only_passes_null_rule_and_punctuated_id(spark):
    s = supplier(1)
    cnpj = make_cnpj("112223330001")
    punct = f"{cnpj[:2]}.{cnpj[2:5]}.{cnpj[5:8]}/{cnpj[8:12]}-{cnpj[12:]}"
    rows = [invoice(s, 1, "30 dias") | {"NOME_ITEM": "   "}, invoice(s, 2, "30 dias") | {"CNPJ_FORNECEDOR": punct}]
    bad, ok = reasons(spark, rows)
    assert bad == {} and ok == {"1", "2"}


def test_duplicate_that_also_fails_reports_both(spark):
    s = supplier(1)
    row = invoice(s, 1, "30 dias") | {"CNPJ_FORNECEDOR": "123"}
    bad, ok = reasons(spark, [row, dict(row)])
    assert bad == {"1": "duplicated, invalid CNPJ"} and ok == set()


def test_validate_generic_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "z"), (4, "b")], "k int, v string")
    dim = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    v = validate(df, [
        rule_duplicated(),
        rule_not_null(["v"]),
        rule_in_domain("v", ["a", "b"], "bad v"),
        rule_in_lookup("k", dim, "k", "no k", broadcast=False),  # force the shuffle path
        rule_expr(F.col("k") > 3, "big k", blocking=False),
    ])
    rej = {r.k: r.inconsistencies for r in v.rejected.collect()}
    assert rej == {1: "duplicated", 2: "null column(s)", 3: "bad v", 4: "no k, big k"}
    assert sorted(r.k for r in v.accepted.collect()) == [1]


def test_validate_plan_is_one_aggregation_and_broadcast_lookup(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    dim = spark.createDataFrame([(1,)], "k int")
    v = validate(df, [rule_duplicated(), rule_in_lookup("k", dim, "k", "no k", broadcast=True)])
    plan = v.rejected._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "BatchEvalPython" not in plan


def test_validate_without_distinct_is_map_only(spark):
    import pytest

    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    v = validate(df, [rule_not_null(["v"]), rule_in_lookup("k", dim, "k", "no k", broadcast=True)], distinct=False)
    assert sorted(tuple(r) for r in v.accepted.collect()) == [(1, "a"), (1, "a")]
    assert [tuple(r) for r in v.rejected.collect()] == [(2, None, "null column(s)")]
    plan = v.accepted._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan.split("BroadcastExchange")[0]
    with pytest.raises(ValueError):
        validate(df, [rule_duplicated()], distinct=False)


def test_materialize_gives_the_same_outputs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "z")], "k int, v string")
    rules = [rule_duplicated(), rule_not_null(["v"]), rule_in_domain("v", ["a"], "bad v")]
    v = validate(df, rules)
    m = validate(df, rules).materialize(str(tmp_path / "annotated"))
    assert sorted(map(tuple, v.accepted.collect())) == sorted(map(tuple, m.accepted.collect())) == [(1, "a")]
    assert sorted(map(tuple, v.rejected.collect()), key=str) == sorted(map(tuple, m.rejected.collect()), key=str)
    assert m.stats().first().asDict() == {"written": 1, "rejected": 3}
