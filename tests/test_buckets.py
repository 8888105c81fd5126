import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import DuplicateKeyError, upsert_snapshot
from ledgerflow.operators.bitmaps import bit_is_set, key_bitmaps, mark_members
from ledgerflow.operators.upsert import stage_source
from ledgerflow.plans import claims
from ledgerflow.plans.buckets import BUCKET, BucketTable, routed

SCHEMA = T.StructType().add("k", "long").add("v", "string")


def make(spark, tmp_path, n=2000, **kw):
    t = BucketTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], **{"n_buckets": 16, **kw})
    assert t.upsert(spark.range(n).selectExpr("id AS k", "'old' AS v")) | {"buckets": 0} == {"INSERT": n, "UPDATE": 0, "buckets": 0}
    return t


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_one_key_rewrites_one_bucket_and_shuffles_no_target_row(spark, tmp_path):
    t = make(spark, tmp_path)
    before = t.layout()
    one = spark.createDataFrame([(5, "new")], SCHEMA)
    staged, _ = stage_source(routed(one, ["k"], 16))
    touched = [r[0] for r in staged.select(BUCKET).collect()]
    old, inserts = t.plan(staged, touched)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and " Exchange " not in plan.replace("BroadcastExchange", "")
    assert plan.count("FileScan") == 2 and f"{BUCKET}={touched[0]}" in "".join(old.inputFiles())
    assert {f.rsplit(f"/{BUCKET}=", 1)[1].split("/")[0] for f in old.inputFiles() if f"/{BUCKET}=" in f} == {str(touched[0])}
    assert inserts.count() == 0
    assert t.upsert(one) == {"INSERT": 0, "UPDATE": 1, "buckets": 1}
    assert {b for b, v in t.layout().items() if v != before[b]} == set(touched)
    assert t.read().where("k = 5").first().v == "new" and t.read().count() == 2000
    assert t.read(version=1).where("k = 5").first().v == "old"


@pytest.mark.parametrize("threshold", ["32MB", "0"])
def test_equals_the_whole_merge(spark, tmp_path, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        t = make(spark, tmp_path, 300)
        state = t.read()
        for k in (1, 7):
            source = spark.range(0, 600, k).selectExpr("id AS k", f"concat('v{k}-', id % 3) AS v").union(spark.createDataFrame([(None, "n")] * k, SCHEMA))
            want = upsert_snapshot(state, source, ["k"])
            got = t.upsert(source)
            counts = {r.action: r.cnt for r in want.stats.collect()}
            assert got["INSERT"] == counts.get("INSERT", 0) and got["UPDATE"] == counts.get("UPDATE", 0)
            assert rows(t.read()) == rows(want.state)
            state = t.read()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")


def test_only_changed_latest_and_duplicates(spark, tmp_path):
    t = make(spark, tmp_path, 50)
    twice = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        t.upsert(twice)
    assert t.upsert(twice, on_duplicate="latest", order_by=["v"])["UPDATE"] == 1
    assert t.upsert(spark.createDataFrame([(1, "b"), (2, "c")], SCHEMA), only_changed=True)["UPDATE"] == 1
    assert t.upsert(spark.createDataFrame([], SCHEMA)) == {"INSERT": 0, "UPDATE": 0, "buckets": 0}
    assert rows(t.read().where("k < 3")) == [(0, "old"), (1, "b"), (2, "c")]


def test_a_failed_write_is_never_seen_and_gives_its_claim_back(spark, tmp_path):
    t = make(spark, tmp_path, 50)
    bad = spark.range(3).select("id", F.when(F.col("id") < 5, F.raise_error(F.lit("broken"))).cast("string").alias("v")).withColumnRenamed("id", "k")
    with pytest.raises(Exception, match="broken"):
        t.upsert(bad)
    (tmp_path / "t" / "version=2" / "bucket=3").mkdir(parents=True)  # left by a process that died while writing
    assert t.read().count() == 50
    assert t.upsert(spark.createDataFrame([(1, "x")], SCHEMA))["UPDATE"] == 1
    assert t.versions() == [1, 3]


def test_a_claimed_version_stops_other_writers_until_it_is_stale(spark, tmp_path):
    t = make(spark, tmp_path, 50)
    assert claims.create(spark, f"{t.path}/_claims/version=2")
    one = spark.createDataFrame([(1, "x")], SCHEMA)
    with pytest.raises(claims.ConcurrentWriteError):
        t.upsert(one)
    t.stale_after = 0.0
    assert t.upsert(one)["UPDATE"] == 1 and t.versions() == [1, 3]


def test_of_two_writers_one_wins_and_ids_are_unique(spark, tmp_path):
    schema = T.StructType().add("id", "long").add("k", "long").add("v", "string")
    t = BucketTable(spark, str(tmp_path / "t"), schema, ["k"], n_buckets=4, identity_col="id")
    t.upsert(spark.range(10).selectExpr("id AS k", "'a' AS v"))
    gate, out = threading.Barrier(2), []

    def write(first):
        source = spark.range(first, first + 20).selectExpr("id AS k", "'b' AS v")
        gate.wait()
        try:
            out.append(t.upsert(source)["INSERT"])
        except claims.ConcurrentWriteError:
            out.append("lost")

    threads = [threading.Thread(target=write, args=(f,)) for f in (100, 200)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert sorted(map(str, out)) == ["20", "lost"]
    t.upsert(spark.createDataFrame([(999, "c")], "k long, v string"))
    ids = sorted(r.id for r in t.read().collect())
    assert ids == list(range(1, 32))


def test_exclusive_create(spark, tmp_path):
    path, out = f"{tmp_path}/c/claim", []
    gate = threading.Barrier(8)

    def race():
        gate.wait()
        out.append(claims.create(spark, path))

    threads = [threading.Thread(target=race) for _ in range(8)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert sorted(out) == [False] * 7 + [True]


def test_vacuum_keeps_what_the_kept_versions_read(spark, tmp_path):
    t = make(spark, tmp_path, 200)
    for i in range(4):
        t.upsert(spark.createDataFrame([(i, f"v{i}")], SCHEMA))
    want = {v: rows(t.read(version=v)) for v in t.versions()[-2:]}
    assert t.vacuum(2) > 0
    assert {v: rows(t.read(version=v)) for v in want} == want


def test_table_keeps_its_number_of_buckets_and_collated_keys_share_one(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("v", "integer")
    t = BucketTable(spark, str(tmp_path / "t"), schema, ["k"], n_buckets=8, collation="UNICODE_CI_RTRIM")
    t.upsert(spark.createDataFrame([("Ação", 1), ("b  ", 2), (None, 3)], schema))
    again = BucketTable(spark, str(tmp_path / "t"), schema, ["k"], n_buckets=99, collation="UNICODE_CI_RTRIM")
    assert again.n_buckets == 8
    assert again.upsert(spark.createDataFrame([("AÇÃO ", 10), ("B", 20), ("c", 30)], schema)) | {"buckets": 0} == {"INSERT": 1, "UPDATE": 2, "buckets": 0}
    assert sorted(r.v for r in again.read().collect()) == [3, 10, 20, 30]


def test_bitmaps_are_exact(spark):
    keys = spark.range(-40_000, 70_000, 3).selectExpr("id AS k").union(spark.createDataFrame([(None,), (9_000_000_000,), (-(2**62),)], "k long"))
    bits = key_bitmaps(keys, "k")
    probe = spark.range(-50_000, 80_000).selectExpr("id AS x").union(spark.createDataFrame([(None,), (9_000_000_000,), (9_000_000_001,), (-(2**62),)], "x long"))
    for broadcast in (True, None):
        marked = mark_members(probe, F.col("x"), bits, "hit", broadcast=broadcast)
        plain = probe.join(keys.distinct().withColumn("hit", F.lit(True)), F.col("x") == F.col("k"), "left")
        assert marked.where("hit").count() == plain.where("hit").count()
        assert marked.where("hit").select("x").exceptAll(plain.where("hit").select("x")).count() == 0
        assert marked.count() == probe.count()
    assert bit_is_set is not None
