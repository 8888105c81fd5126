"""Headline workloads for the benchmark: the reference's jobs on big tables.

* quarantine over every ``lineitem`` column with all five rule kinds
  (duplicate, not-null, domain, check digit, lookup), both outputs produced
  from one grouped pass;
* installment schedule with status over ``orders``;
* keyed upserts of ``customer`` and ``orders`` snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import (
    rule_check_digit, rule_duplicated, rule_in_domain, rule_in_lookup, rule_not_null, upsert_snapshot, validate,
)
from ledgerflow.plans.catalog import table


def lineitem_quarantine(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem")
    li = li.withColumn("tax_id", F.lpad((F.col("l_orderkey") * 10007 + 33000167).cast("string"), 14, "0"))
    # every fiftieth part key is broken
    li = li.withColumn("l_partkey", F.when(F.col("l_partkey") % 50 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")))
    part = table(spark, sf_dir, "part", "p_partkey")
    rules = [
        rule_duplicated(),
        rule_not_null(),
        rule_in_domain("l_linestatus", ["O", "F"], "invalid line status"),
        rule_check_digit("tax_id", "invalid tax id"),
        rule_in_lookup("l_partkey", part, "p_partkey", "invalid part"),
    ]
    return validate(li, rules)


def orders_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    source = o.withColumn("o_orderkey", F.col("o_orderkey") * 2).withColumn("o_orderpriority", F.lower("o_orderpriority"))
    return upsert_snapshot(o, source, ["o_orderkey"]).merged


def customer_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    source = c.withColumn("c_custkey", F.col("c_custkey") * 2).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return upsert_snapshot(c, source, ["c_custkey"], only_changed=True).merged
