import re

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import (
    DuplicateKeyError, assign_surrogate_keys, check_length, check_not_null, check_references, check_unique,
    lookup_join, merge_stats, upsert_snapshot,
)


def stats(res):
    return {r.action: r.cnt for r in res.stats.collect()}


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_upsert_insert_update_keep_and_null_keys(spark, strategy):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "t")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "s1"), (None, "s2")], "k int, v string")
    res = upsert_snapshot(target, source, ["k"], strategy=strategy)
    state = sorted((r.k or 0, r.v) for r in res.state.collect())
    assert state == [(0, "s1"), (0, "s2"), (0, "t"), (1, "a"), (2, "B"), (3, "C")]
    assert stats(res) == {"UPDATE": 1, "INSERT": 3}


def test_upsert_duplicates_raise_or_latest(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k int, v string, ver int")
    source = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "n", 5), (None, "m", 5), (None, "m", 5)], "k int, v string, ver int")
    with pytest.raises(DuplicateKeyError):
        upsert_snapshot(target, source, ["k"])
    res = upsert_snapshot(target, source, ["k"], on_duplicate="latest", order_by=["ver"])
    assert sorted((r.k or 0, r.v) for r in res.state.collect()) == [(0, "m"), (0, "m"), (0, "n"), (1, "y")]


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_upsert_case_insensitive_and_only_changed(spark, strategy):
    target = spark.createDataFrame([("ABC", 1), ("X", 2)], "k string, v int")
    source = spark.createDataFrame([("abc", 1), ("x", 5)], "k string, v int")
    res = upsert_snapshot(target, source, ["k"], case_insensitive=True, strategy=strategy)
    assert sorted(tuple(r) for r in res.state.collect()) == [("abc", 1), ("x", 5)]
    res = upsert_snapshot(target, source, ["k"], case_insensitive=True, only_changed=True, strategy=strategy)
    assert stats(res) == {"UPDATE": 1}
    # case-sensitive: both are new keys
    assert stats(upsert_snapshot(target, source, ["k"], strategy=strategy)) == {"INSERT": 2}


def test_broadcast_merge_does_not_shuffle_the_target(spark):
    target = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    source = spark.createDataFrame([(5, -1), (5000, 7)], "k long, v long")
    merged = upsert_snapshot(target, source, ["k"], strategy="broadcast").merged
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "BroadcastHashJoin" in plan
    rows = {r.k: (r.v, r._action) for r in merged.collect()}
    assert rows[5] == (-1, "UPDATE") and rows[5000] == (7, "INSERT") and rows[6] == (12, None) and len(rows) == 1001


def test_upsert_identity(spark):
    target = spark.createDataFrame([(10, "a", "1"), (11, "b", "2")], "id long, k string, v string")
    source = spark.createDataFrame([("b", "22"), ("c", "3"), ("d", "4")], "k string, v string")
    res = upsert_snapshot(target, source, ["k"], identity_col="id")
    rows = {r.k: (r.id, r.v) for r in res.state.collect()}
    assert rows["a"] == (10, "1") and rows["b"] == (11, "22")
    assert sorted([rows["c"][0], rows["d"][0]]) == [12, 13]


def test_surrogate_keys_consecutive(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "x")
    ids = assign_surrogate_keys(df, "sk", base=100)
    got = sorted(r.sk for r in ids.collect())
    assert got == list(range(101, 1101))


def test_lookup_join_null_keys_and_paths(spark):
    left = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b"), (9, "z")], "k int, v string")
    right = spark.createDataFrame([(1, "one"), (2, "two")], "rk int, name string")
    for broadcast in (True, False, None):
        got = sorted((r.k or 0, r.name) for r in lookup_join(left, right, ["k"], ["rk"], "left", broadcast=broadcast).collect())
        assert got == [(0, None), (1, "one"), (2, "two"), (9, None)]
        anti = sorted(r.k or 0 for r in lookup_join(left, right, ["k"], ["rk"], "left_anti", broadcast=broadcast).collect())
        assert anti == [0, 9]
        inner = sorted(r.k for r in lookup_join(left, right, ["k"], ["rk"], "inner", broadcast=broadcast).collect())
        assert inner == [1, 2]
    plan = lookup_join(left, right, ["k"], ["rk"], "left", broadcast=False)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[__lf_lk0#\d+, __lf_salt#\d+L\]", plan)  # the salt is part of the join key
    assert "Union" not in plan


def test_self_join_anti(spark):
    df = spark.createDataFrame([(1, "F"), (2, "O"), (3, "F")], "k int, s string")
    from ledgerflow.operators import subtract_by_key

    assert [r.k for r in subtract_by_key(df, df.where(F.col("s") == "F"), ["k"]).collect()] == [2]


def test_constraints(spark):
    df = spark.createDataFrame([(1, 1, "abcdef"), (1, 1, None), (2, 5, "x")], "a int, fk int, t string")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [tuple(r) for r in check_unique(df, ["a"]).collect()] == [(1, 2)]
    assert [r.a for r in check_references(df, ["fk"], parent, ["pk"]).collect()] == [2]
    r = check_not_null(df, ["t", "fk"], by_column=True).first()
    assert (r.n, r.n_t, r.n_fk) == (1, 1, 0)
    assert [tuple(r) for r in check_length(df, "t", 3, keep=["a"]).collect()] == [(1, 6)]
    assert merge_stats is not None


def test_lookup_join_salted_hot_key(spark):
    # key 7 holds a third of the rows
    left = spark.range(0, 3000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("k"), F.col("id").alias("row"))
    left = left.union(spark.createDataFrame([(None, -1)], "k long, row long"))
    right = spark.range(0, 3000, 2).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("val"))
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x or 0) for x in t))

    for how in ("inner", "left", "left_anti"):
        plain = rows(lookup_join(left, right, ["k"], ["rk"], how, broadcast=True))
        salted = lookup_join(left, right, ["k"], ["rk"], how, broadcast=False, salt_hot_keys=500, salt_buckets=8)
        assert rows(salted) == plain, how
        assert "__lf_hot" in salted._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_upsert_identity_both_strategies(spark, strategy):
    target = spark.createDataFrame([(10, "a", "1"), (11, "b", "2"), (12, None, "n")], "id long, k string, v string")
    source = spark.createDataFrame([("b", "22"), ("c", "3"), (None, "4")], "k string, v string")
    res = upsert_snapshot(target, source, ["k"], identity_col="id", strategy=strategy)
    rows = sorted((r.id, r.k, r.v) for r in res.state.collect())
    assert rows[:3] == [(10, "a", "1"), (11, "b", "22"), (12, None, "n")]
    assert sorted(r[0] for r in rows[3:]) == [13, 14] and {r[2] for r in rows[3:]} == {"3", "4"}


STRATEGIES = ["auto", "broadcast", "shuffle"]


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x or 0) for x in t))


def test_strategies_give_the_same_table_with_null_and_given_ids(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, None, "b"), (None, 7, "n")], "k int, id long, v string")
    source = spark.createDataFrame([(3, 77, "c"), (2, 78, "B")], "k int, id long, v string")
    states = [sorted_rows(upsert_snapshot(target, source, ["k"], identity_col="id", strategy=s).state) for s in STRATEGIES]
    # stored ids stay (NULL too), the source's ids are ignored, inserts go on above the maximum
    assert states[0] == [(1, 1, "a"), (2, None, "B"), (3, 8, "c"), (None, 7, "n")]
    assert states[1] == states[0] and states[2] == states[0]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_keys_that_differ_in_case_only_are_duplicates(spark, strategy):
    target = spark.createDataFrame([(10, "ABC", 1)], "id long, k string, v int")
    source = spark.createDataFrame([("abc", 2), ("Abc", 3), ("x", 4)], "k string, v int")
    with pytest.raises(DuplicateKeyError):
        upsert_snapshot(target, source, ["k"], case_insensitive=True, strategy=strategy)
    res = upsert_snapshot(target, source, ["k"], case_insensitive=True, on_duplicate="latest", order_by=["v"], identity_col="id", strategy=strategy)
    assert sorted_rows(res.state) == [(10, "Abc", 3), (11, "x", 4)]


def test_merge_reads_each_side_once_in_a_shuffle(spark, tmp_path):
    spark.range(500).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.createDataFrame([(5, -1), (None, 7), (None, 7)], "k long, v long")
    merged = upsert_snapshot(target, source, ["k"], strategy="shuffle").merged
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    # the target and the staged source
    assert plan.count("Relation [") == 2 and "FullOuter" in plan and "Union" not in plan
    assert merged.count() == 502 and merged.where("k IS NULL").count() == 2


def test_null_keys_of_target_and_source_never_meet(spark):
    target = spark.range(3000).selectExpr("CAST(NULL AS LONG) AS k", "id AS v")
    source = spark.range(3000).selectExpr("CAST(NULL AS LONG) AS k", "-id - 1 AS v")
    for strategy in STRATEGIES:
        assert stats(upsert_snapshot(target, source, ["k"], strategy=strategy)) == {"INSERT": 3000}


def test_identity_checkpoints_no_target_rows(spark, monkeypatch):
    frame = type(spark.range(1))
    sizes = []
    real = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, eager=True: (sizes.append(self.count()), real(self, eager))[1])
    target = spark.range(1000).selectExpr("id + 1 AS id", "id AS k", "'t' AS v")
    source = spark.createDataFrame([(5, "s"), (5000, "s")], "k long, v string")
    assert upsert_snapshot(target, source, ["k"], identity_col="id", strategy="shuffle").state.count() == 1001
    assert max(sizes) <= 2


def test_a_small_source_is_not_shuffled_against_a_large_target(spark, tmp_path):
    spark.range(100_000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(99_990, 100_010).selectExpr("id AS k", "-id AS v").union(spark.createDataFrame([(None, 7)] * 3, "k long, v long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # of the source's bytes, not of the target's
    try:
        res = upsert_snapshot(target, source, ["k"])
        plan = res.merged._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_construct_agg" in plan and "SortMergeJoin" not in plan
        assert stats(res) == {"UPDATE": 10, "INSERT": 13}
        assert sorted_rows(res.state.where("k >= 99990 OR k IS NULL")) == sorted_rows(source)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
    res.close()
