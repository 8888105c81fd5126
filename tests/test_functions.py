import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import break_cnpj, make_cnpj
from ledgerflow.functions import (
    canonicalize, cast_columns, cnpj_is_valid, with_cnpj_valid, concat_labels, parse_date, to_decimal, trim_strings, try_int, upper_trim,
)


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_trim_strings_whitespace_only_is_empty_not_null(spark):
    df = spark.createDataFrame([("  a ", "   ", None, 1)], "a string, b string, c string, n int")
    r = trim_strings(df).first()
    assert (r.a, r.b, r.c, r.n) == ("a", "", None, 1)
    r = trim_strings(df, empty_to_null=True, upper=["a"]).first()
    assert (r.a, r.b) == ("A", None)


def test_upper_trim(spark):
    assert one_col(spark, ["  sp "]).select(upper_trim("v")).first()[0] == "SP"


def test_canonicalize_unknown_null_and_large_map(spark):
    m = {"ENTRADA/30/60/90 DIAS": "30/60/90 DIAS", "A VISTA": "A VISTA"}
    rows = one_col(spark, ["A VISTA", "ENTRADA/30/60/90 DIAS", "30/60/90 DIAS", None]).select(canonicalize("v", m).alias("c")).collect()
    assert [r.c for r in rows] == ["A VISTA", "30/60/90 DIAS", "30/60/90 DIAS (invalid)", None]
    big = {f"K{i}": f"V{i}" for i in range(500)}
    rows = one_col(spark, ["K7", "nope", None]).select(canonicalize("v", big, invalid_suffix=None).alias("c")).collect()
    assert [r.c for r in rows] == ["V7", None, None]


def test_try_casts_and_dates(spark):
    df = spark.createDataFrame([("12", "1234.56", "2023-01-31"), ("x", "abc", "2023-02-30"), (None, None, None)], "i string, d string, t string")
    rows = df.select(try_int("i").alias("i"), to_decimal("d").alias("d"), parse_date("t").alias("t")).collect()
    assert rows[0] == (12, Decimal("1234.56"), dt.date(2023, 1, 31))
    assert rows[1] == (None, None, None)
    assert rows[2] == (None, None, None)
    typed = cast_columns(df, {"i": "int", "d": "decimal(10,2)", "t": "date"})
    assert dict(typed.dtypes) == {"i": "int", "d": "decimal(10,2)", "t": "date"}


def test_concat_labels_order(spark):
    df = spark.createDataFrame([(True, False, True), (False, False, False)], "a boolean, b boolean, c boolean")
    rows = df.select(concat_labels([(F.col("a"), "A"), (F.col("b"), "B"), (F.col("c"), "C")]).alias("r")).collect()
    assert [r.r for r in rows] == ["A, C", ""]


@pytest.mark.parametrize(
    "value, ok",
    [
        (make_cnpj("112223330001"), True),
        ("11.222.333/0001-81", True),              # punctuated, well known valid id
        ("11222333000181", True),
        ("11222333000182", False),                 # wrong second digit
        (break_cnpj(make_cnpj("604002220001")), False),
        ("1222333000181", False),                  # 13 digits
        ("0011222333000181", False),               # 16 digits
        ("112223330001", False),                   # 12 digits
        ("11222333000l81", False),                 # a letter
        ("11 222 333 0001 81", False),             # spaces are not allowed punctuation
        ("00000000000000", False),                 # one repeated digit
        ("11111111111111", False),
        ("", False),
        (None, False),
    ],
)
def test_cnpj_is_valid(spark, value, ok):
    assert one_col(spark, [value]).select(cnpj_is_valid("v")).first()[0] is ok
    assert with_cnpj_valid(one_col(spark, [value]), "v", "ok").first().ok is ok


def test_cnpj_matches_python_reference_algorithm(spark):
    # many generated ids, valid and broken, checked against the Python generator
    ids = [make_cnpj(f"{i * 7919 % 10**8:08d}{i % 10000:04d}") for i in range(1, 400)]
    ids += [break_cnpj(x) for x in ids[:200]]
    df = one_col(spark, ids).select("v", cnpj_is_valid("v").alias("ok"))
    got = {r.v: r.ok for r in df.collect()}
    assert got == {r.v: r.ok for r in with_cnpj_valid(one_col(spark, ids), "v", "ok").collect()}
    for x in ids[:399]:
        assert got[x] is (len(set(x)) > 1)
    for x in ids[399:]:
        assert got[x] is False


def test_cnpj_predicate_stays_in_jvm(spark):
    plan = one_col(spark, ["11222333000181"]).select(cnpj_is_valid("v"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
