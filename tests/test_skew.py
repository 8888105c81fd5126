"""Hot groups: one value holding a third of all rows."""

from pyspark.sql import functions as F

from ledgerflow.operators import check_unique, rule_duplicated, rule_expr, rule_in_lookup, upsert_snapshot, validate


def shuffle_records_per_partition(df):
    # rows per partition of the (post-shuffle) result, without collecting rows
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_hot_duplicate_group_is_pre_aggregated(spark):
    n = 30_000
    base = spark.range(0, n, numPartitions=8)
    df = base.select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    v = validate(df, [rule_duplicated()])
    plan = v.annotated._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # map-side combine before the exchange
    rej = v.rejected.collect()
    assert [(r.k, r.inconsistencies) for r in rej] == [(-1, "duplicated")]
    assert v.accepted.count() == n - n // 3 + 1
    counts = check_unique(df, ["k"]).collect()
    assert [(r.k, r.n) for r in counts] == [(-1, n // 3)]


def test_hot_lookup_key_salted_and_unsalted_agree(spark):
    n = 30_000
    df = spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    dim = spark.range(0, n, 2).select(F.col("id").alias("k"))
    plain = validate(df, [rule_in_lookup("k", dim, "k", "no k")]).rejected.count()
    salted = validate(df, [rule_in_lookup("k", dim, "k", "no k", broadcast=False, salt_hot_keys=1000)]).rejected.count()
    expected = df.where((F.col("k") % 2) == 1).count()
    assert plain == salted == expected


def test_null_key_third_spread_in_shuffle_upsert(spark):
    n = 9_000
    target = spark.range(0, n, numPartitions=4).select(F.col("id").alias("k"), F.lit("t").alias("v"))
    source = spark.range(0, n, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") + n // 2).cast("long").alias("k"), F.lit("s").alias("v"))
    res = upsert_snapshot(target, source, ["k"], strategy="shuffle")
    merged = res.merged
    stats = {r.action: r.cnt for r in res.stats.collect()}
    nulls = n // 3
    matched = source.where(F.col("k") < n).count()
    assert stats == {"INSERT": n - matched, "UPDATE": matched}
    assert merged.where(F.col("k").isNull()).count() == nulls
    # the NULL-key rows do not all land in one post-shuffle partition
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = shuffle_records_per_partition(
            upsert_snapshot(target, source, ["k"], strategy="shuffle").merged.where(F.col("k").isNull()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < nulls / 2


def test_sized_shuffle_sets_and_restores_initial_partitions(spark):
    from ledgerflow.session import sized_shuffle

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    with sized_shuffle(spark, df) as parts:  # tiny input: configured count kept
        assert parts is None
    with sized_shuffle(spark, df, target_bytes=1024) as parts:  # 1 KB per partition
        assert parts is not None and parts > 4 and int(spark.conf.get(key)) == parts
    assert spark.conf.get(key, None) is None


def test_published_quarantine_task_holds_few_rows(spark, tmp_path, monkeypatch):
    from ledgerflow import session
    from ledgerflow.plans.jobs import publish_quarantine

    monkeypatch.setattr(session, "TASK_BYTES", 1024 * 1024, raising=False)
    n = 600_000
    rows = spark.range(0, n, numPartitions=8).select("id", (F.col("id") % 7).alias("code"), F.xxhash64("id").alias("v"))
    rows.union(rows.where("id % 10 = 0")).write.parquet(str(tmp_path / "in"))
    v = validate(spark.read.parquet(str(tmp_path / "in")), [rule_duplicated(), rule_expr(F.col("code") == 3, "code 3")])
    before = spark.conf.getAll
    stats = publish_quarantine(v, str(tmp_path / "out"))
    assert spark.conf.getAll == before
    assert stats == {"written": v.accepted.count(), "rejected": v.rejected.count()}
    back = spark.read.parquet(str(tmp_path / "out/rows"))
    assert back.count() == back.select("id").distinct().count() == n
    # a task's rows of one verdict are one file
    per_task = back.groupBy(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)).count().agg(F.max("count")).first()[0]
    assert per_task < n / 8


def test_small_tasks_sizes(spark, tmp_path):
    from ledgerflow.session import small_tasks

    split, advisory, parts = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    # the sides of a join count once each, not as their product
    with small_tasks(spark, df.join(df.withColumnRenamed("id", "k"), F.col("id") == F.col("k")), task_bytes=65536, max_tasks=20) as n:
        assert n == 20 and int(spark.conf.get(split)) < 1_000_000
    spark.conf.set(split, "1000b")
    spark.conf.set(parts, "70")
    try:
        with small_tasks(spark, df, task_bytes=65536) as n:
            assert n >= 70 and int(spark.conf.get(split)) == 1000 and int(spark.conf.get(advisory)) == 65536
        assert spark.conf.get(split) == "1000b" and spark.conf.get(parts) == "70"
    finally:
        spark.conf.set(split, "128MB")
        spark.conf.unset(parts)


def test_a_side_of_much_text_is_not_broadcast(spark):
    # 100,000 rows of 20 KB: few rows, but the optimizer and AQE go by bytes
    from ledgerflow.operators import lookup_join

    right = spark.range(100_000).selectExpr("id AS rk", "repeat('x', 20000) AS t")
    left = spark.range(10).selectExpr("id AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
    try:
        joined = lookup_join(left, right, ["k"], ["rk"], "left").selectExpr("k", "length(t) AS n")
        assert sorted(tuple(r) for r in joined.collect()) == [(i, 20000) for i in range(10)]
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")


def test_identical_hot_rows_spread_over_tasks(spark):
    from ledgerflow.operators import lookup_join

    left = spark.range(0, 8000, numPartitions=4).selectExpr("1L AS k", "'same' AS v")
    right = spark.createDataFrame([(1, "one")], "rk long, name string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = shuffle_records_per_partition(lookup_join(left, right, ["k"], ["rk"], "left", broadcast=False, salt_hot_keys=1000))
        nulls = spark.range(0, 8000, numPartitions=4).selectExpr("CASE WHEN id < 0 THEN id END AS k", "'same' AS v")
        null_sizes = shuffle_records_per_partition(lookup_join(nulls, right, ["k"], ["rk"], "left", broadcast=False))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == sum(null_sizes) == 8000
    assert max(sizes) < 2000 and max(null_sizes) < 2000


def test_lookups_in_one_pass(spark, tmp_path):
    """With k shuffled lookup rules the input is read once, not 2 ** k times."""
    spark.range(400).selectExpr("id AS a", "id % 7 AS b", "nullif(id % 5, 0) AS c").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    dim = spark.range(3).toDF("d")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for k in (1, 2, 3):
            rules = [rule_in_lookup(c, dim, "d", f"no {c}", broadcast=False) for c in ("a", "b", "c")[:k]]
            v = validate(df, rules)
            plan = v.annotated._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan parquet") == 1, k
            assert plan.count("SortMergeJoin") == k
            assert v.rejected.count() == 400 - len([i for i in range(400) if i < 3 and (k < 2 or i % 7 < 3) and (k < 3 or i % 5 in (1, 2))])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unmatched_rows_are_counted_whole(spark):
    from pyspark.sql import Observation

    from ledgerflow.operators import Lookup, resolve_keys

    target = spark.createDataFrame([], "k long, name string")
    df = spark.range(0, 4000, numPartitions=4).selectExpr("id AS k")
    dim = spark.range(2000).selectExpr("id AS dk", "'x' AS name")
    for strategy in ("auto", "broadcast", "shuffle"):
        obs = Observation(f"unmatched-{strategy}")
        source = resolve_keys(df, [Lookup(dim, "k", "dk", take={"name": "name"})], observe=obs)
        assert upsert_snapshot(target, source, ["k"], strategy=strategy).state.count() == 2000
        assert obs.get["unmatched_0"] == 2000


def test_collect_labels_hot_group(spark):
    from ledgerflow.operators import collect_labels

    n = 30_000
    ev = spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id")).alias("user_id"),
        F.element_at(F.array(F.lit("view"), F.lit("click"), F.lit("buy")), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
    )
    out = {r.user_id: r.types for r in collect_labels(ev, ["user_id"], "event_type", "types").collect()}
    assert out[42] == "view"  # id % 3 == 0 → the first label only
    assert len(out) == n - n // 3 + 1
    plan = collect_labels(ev, ["user_id"], "event_type", "types")._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan
