import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import DuplicateKeyError, Lookup, check_references, check_unique, lookup_join, resolve_keys, rule_in_lookup, upsert_snapshot, validate

CI = "UNICODE_CI_RTRIM"

#: Pairs that the declared collation holds for equal, and whether lower() does.
EQUAL = [
    ("abc", "ABC", True),
    ("Ação", "AÇÃO", True),
    ("abc", "abc  ", False),  # trailing blanks
    ("ABC ", "abc", False),
    ("ΟΔΟΣ", "οδο\u03c3", False),  # the final sigma
    ("é", "é", False),  # one code point or two
    ("K", "K", True),  # the kelvin sign
]
DIFFERENT = [("acao", "ação"), ("i", "İ"), ("ı", "i"), (" abc", "abc"), ("a", "b")]


@pytest.fixture
def pairs(spark):
    rows = [(i, a, b) for i, (a, b, *_) in enumerate([*EQUAL, *DIFFERENT])]
    return spark.createDataFrame(rows, "n int, a string, b string")


def test_where_lower_differs(pairs):
    got = {r.n: (r.same, r.low) for r in pairs.select("n", (F.collate("a", CI) == F.collate("b", CI)).alias("same"), (F.lower("a") == F.lower("b")).alias("low")).collect()}
    assert [got[i][0] for i in range(len(got))] == [True] * len(EQUAL) + [False] * len(DIFFERENT)
    assert [got[i][1] for i in range(len(EQUAL))] == [low for *_, low in EQUAL]


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_joins_go_by_the_collation(spark, broadcast):
    left = spark.createDataFrame([(i, a) for i, (a, *_) in enumerate([*EQUAL, *DIFFERENT])] + [(99, None)], "n int, a string")
    for i, (_, b, *_) in enumerate([*EQUAL, *DIFFERENT]):
        right = spark.createDataFrame([(b, i)], "b string, m int")
        joined = lookup_join(left.where(F.col("n") == i), right, ["a"], ["b"], "inner", broadcast=broadcast, collation=CI)
        assert joined.count() == (i < len(EQUAL)), (i, b)
        if broadcast is None:
            break
    right = spark.createDataFrame([("ABC  ",)], "b string")
    for how, n in (("left", 2), ("left_semi", 1), ("left_anti", 1)):
        assert lookup_join(left.where("n IN (0, 99)"), right, ["a"], ["b"], how, broadcast=broadcast, collation=CI).count() == n


def test_rules_lookups_and_constraints(spark):
    dim = spark.createDataFrame([("ABC",), ("abc ",), ("Ação",)], "d string")
    df = spark.createDataFrame([(1, "abc"), (2, "AÇÃO  "), (3, "acao"), (4, None)], "k int, t string")
    v = validate(df, [rule_in_lookup("t", dim, "d", "unknown", collation=CI)])
    assert sorted(r.k for r in v.rejected.collect()) == [3, 4]
    assert [r.k for r in check_references(df, ["t"], dim, ["d"], collation=CI).collect()] == [3]
    assert [tuple(r) for r in check_unique(dim, ["d"], collation=CI).collect()] == [("ABC", 2)]
    one = spark.createDataFrame([("ABC", 7), ("Ação", 8)], "d string, id int")
    assert sorted((r.k, r.id) for r in resolve_keys(df, [Lookup(one, "t", "d", take={"id": "id"}, collation=CI)]).collect()) == [(1, 7), (2, 8)]


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle"])
def test_merge_keys(spark, strategy):
    target = spark.createDataFrame([(1, "Ação", 1), (2, "ABC", 2), (3, None, 3)], "id long, k string, v int")
    source = spark.createDataFrame([("AÇÃO ", 10), ("abc", 20), ("acao", 30), (None, 40)], "k string, v int")
    res = upsert_snapshot(target, source, ["k"], collation=CI, identity_col="id", strategy=strategy)
    got = {r.id: (r.k, r.v) for r in res.state.collect()}
    assert (got[1], got[2], got[3]) == (("AÇÃO ", 10), ("abc", 20), (None, 3)) and sorted(v for _, v in got.values()) == [3, 10, 20, 30, 40]
    twice = spark.createDataFrame([("x", 1), ("X  ", 2)], "k string, v int")
    with pytest.raises(DuplicateKeyError):
        upsert_snapshot(target, twice, ["k"], collation=CI, strategy=strategy)
    last = upsert_snapshot(target, twice, ["k"], collation=CI, on_duplicate="latest", order_by=["v"], strategy=strategy)
    assert [r.k for r in last.state.where("v = 2 AND id IS NULL").collect()] == ["X  "]


def test_the_lakes_text_keys_follow_the_declared_collation(spark, tmp_path):
    from ledgerflow.plans.tables import LakeTables

    rows = [[("11", "a", "old")], [("11 ", "a", "new"), ("ab", "b", "x")], [("AB", "b", "y")]]
    for buckets in (None, 4):
        t = LakeTables(spark, str(tmp_path / f"lake{buckets}"), buckets=buckets)
        counts = [t.upsert("FORNECEDORES", spark.createDataFrame(r, "CNPJ string, NOME string, EMAIL string")) for r in rows]
        assert counts == [{"INSERT": 1, "UPDATE": 0}, {"INSERT": 1, "UPDATE": 1}, {"INSERT": 0, "UPDATE": 1}]
        assert sorted((r.ID_FORNECEDOR, r.EMAIL) for r in t.read("FORNECEDORES").collect()) == [(1, "new"), (2, "y")]
