"""Query catalogue over the driver's tables (one entry per operator).

Every query reads whole tables from ``sf_dir`` and goes through the
library's operators. Dirt (NULLs, padding, failing lookups) is injected by
expression so the oracle SQL can inject the same. Round-trip entries
(CSV / Parquet / JDBC) write the slice and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import canonicalize, drop_nulls, with_cnpj_valid, fill_null, parse_date, to_decimal, trim_strings, try_int, upper_trim, with_row_ids
from ledgerflow.operators import (
    Lookup,
    assign_surrogate_keys,
    check_length,
    check_not_null,
    check_references,
    check_unique,
    collect_labels,
    extract_entity,
    installment_schedule,
    payment_status,
    refresh_status,
    resolve_keys,
    rule_duplicated,
    rule_expr,
    rule_in_domain,
    rule_in_lookup,
    rule_not_null,
    schedule_with_pending,
    subtract_by_key,
    union_distinct,
    upsert_snapshot,
    validate,
)
from ledgerflow.session import scratch_path
from ledgerflow.sources import read_csv, read_csv_checked, read_parquet, typed_schema, write_csv, write_parquet
from ledgerflow.sources import jdbc as J

Query = Callable[[SparkSession, str], DataFrame]

# Order priorities of the driver's tables and their canonical
# classes used by the domain-rule queries.
PRIORITY_MAP = {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM", "5-LOW": "LOW"}
PRIORITIES_OK = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
AS_OF = "1998-06-30"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", cols or None)


def _customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer", "c_custkey")


def _orders_with_bad_keys(spark, sf_dir, *extra) -> DataFrame:
    """Orders of whose customer keys every tenth is broken, so lookups fail."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", *extra)
    bad = F.when(F.col("o_orderkey") % 10 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return o.withColumn("o_custkey", bad)


# ---------------------------------------------------------------- sources


def scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")


def scan_csv_header_strings(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    write_csv(table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal"), path, sep=",", header=True)
    return read_csv(spark, path, header=True)


def scan_csv_schema(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    write_csv(o.withColumn("o_orderdate", F.to_date("o_orderdate")), path, sep=";", header=False)
    schema = typed_schema({"o_orderkey": "bigint", "o_orderpriority": "string", "o_totalprice": "double", "o_orderdate": "date"})
    df = read_csv(spark, path, header=False, sep=";", schema=schema)
    return df.withColumn("o_orderpriority", upper_trim("o_orderpriority"))


def _checked_orders(spark, sf_dir):
    """Orders as lines of text, of which some lack a field, have one too many
    or hold a value that is not of its type."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    price = F.when(k % 13 == 0, F.lit("much")).otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    day = F.when(k % 17 == 0, F.lit("someday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    fields = F.concat_ws(";", k.cast("string"), F.col("o_orderpriority"), price)
    line = F.when(k % 10 == 0, fields).when(k % 11 == 0, F.concat_ws(";", fields, day, F.lit("more"))).otherwise(F.concat_ws(";", fields, day))
    path = scratch_path(spark, "orders-lines")
    o.select(line.alias("value")).write.text(path)
    schema = typed_schema({"o_orderkey": "bigint", "o_orderpriority": "string", "total": "decimal(12,2)", "d": "date"})
    return read_csv_checked(spark, path, schema, header=False, sep=";")


def malformed_lines_q(spark, sf_dir):
    """Every malformed line, word for word, and what is wrong with it."""
    return _checked_orders(spark, sf_dir).malformed.select("line", "reason")


def wellformed_lines(spark, sf_dir):
    return _checked_orders(spark, sf_dir).rows


def _derby(spark, tables: dict[str, DataFrame]) -> J.JdbcConfig:
    cfg = J.derby_memory_config(spark=spark)
    for name, df in tables.items():
        J.write_jdbc(df, cfg, name, mode="overwrite", column_types=J.string_column_types(df, 512))
    return cfg


def jdbc_table_scan(spark, sf_dir):
    cfg = _derby(spark, {"SUPPLIER": table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")})
    return J.read_jdbc(spark, cfg, table="SUPPLIER")


def jdbc_partitioned_scan(spark, sf_dir):
    cfg = _derby(spark, {"CUSTOMER": table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")})
    return J.read_jdbc(spark, cfg, table="CUSTOMER", partition_column="c_custkey", num_partitions=4)


def jdbc_query_scan(spark, sf_dir):
    cfg = _derby(spark, {
        "NATION": table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey"),
        "REGION": table(spark, sf_dir, "region", "r_regionkey", "r_name"),
    })
    q = cfg.q
    sql = (f"SELECT n.{q('n_nationkey')}, n.{q('n_name')}, r.{q('r_name')} FROM NATION n "
           f"INNER JOIN REGION r ON n.{q('n_regionkey')} = r.{q('r_regionkey')}")
    return J.read_jdbc(spark, cfg, query=sql)


def jdbc_filtered_scan(spark, sf_dir):
    cfg = _derby(spark, {"ORDERS": table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")})
    # the equality filter is pushed into the database (PushedFilters)
    return J.read_jdbc(spark, cfg, table="ORDERS").where(F.col("o_orderstatus") == "P").select("o_orderkey", "o_totalprice")


def jdbc_append(spark, sf_dir):
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    cfg = J.derby_memory_config(spark=spark)
    first = nation.where(F.col("n_regionkey") < 2).select("n_nationkey", "n_name")
    J.write_jdbc(first, cfg, "NATION_COPY", mode="append", column_types=J.string_column_types(first, 512))
    rest = nation.where(F.col("n_regionkey") >= 2).select("n_nationkey", "n_name")
    J.insert_into_jdbc(rest, cfg, "NATION_COPY", column_types=J.string_column_types(rest, 512))
    return J.read_jdbc(spark, cfg, table="NATION_COPY")


def sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "orders-parquet")
    write_parquet(table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return read_parquet(spark, path)


def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    write_csv(table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment"), path, sep=";", header=True)
    schema = typed_schema({"c_custkey": "bigint", "c_name": "string", "c_mktsegment": "string"})
    return read_csv(spark, path, header=True, sep=";", schema=schema)


# ---------------------------------------------------------------- upserts


def _customer_upsert(spark, sf_dir):
    # both sides are the whole table; every second source key is in the target
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    source = cust.select((F.col("c_custkey") * 2).alias("c_custkey"), F.lower("c_mktsegment").alias("c_mktsegment"))
    return upsert_snapshot(cust, source, ["c_custkey"])


def upsert_snapshot_q(spark, sf_dir):
    return _customer_upsert(spark, sf_dir).state


def merge_stats_q(spark, sf_dir):
    return _customer_upsert(spark, sf_dir).stats


def jdbc_upsert(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    cfg = _derby(spark, {"SUPPLIER_T": sup})
    source = sup.select((F.col("s_suppkey") * 2).alias("s_suppkey"), F.lower("s_name").alias("s_name"))
    J.upsert_jdbc(source, cfg, "SUPPLIER_T", ["s_suppkey"], column_types=J.string_column_types(source, 512))
    return J.read_jdbc(spark, cfg, table="SUPPLIER_T")


def ci_upsert(spark, sf_dir):
    cust = table(spark, sf_dir, "customer", "c_mktsegment")
    target = cust.select(F.upper("c_mktsegment").alias("segment")).distinct().withColumn("n", F.lit(0).cast("long"))
    source = cust.groupBy(F.lower("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return upsert_snapshot(target, source, ["segment"], case_insensitive=True).state


def upsert_identity(spark, sf_dir):
    """Half of the source's names are new: they get ids above the largest;
    stored ids stay."""
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    target = cust.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("stored"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    name = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.concat(F.lit("new "), "c_name"))
    source = cust.select((-F.col("c_custkey")).alias("id"), name.alias("name"), F.lower("c_mktsegment").alias("segment"))
    state = upsert_snapshot(target, source, ["name"], identity_col="id").state
    return state.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.count_if(F.col("id") == F.col("stored")).alias("n_kept"), F.count_if(F.col("segment") == F.lower("segment")).alias("n_written"),
    )


def upsert_latest(spark, sf_dir):
    """Orders keyed by customer: many rows a key, of which the last one counts."""
    target = table(spark, sf_dir, "customer", "c_custkey").withColumn("last_order", F.lit(0).cast("long"))
    source = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").cast("long").alias("last_order"))
    return upsert_snapshot(target, source, ["c_custkey"], on_duplicate="latest", order_by=["last_order"]).state


def ci_upsert_duplicates(spark, sf_dir):
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    target = cust.select(F.upper("c_mktsegment").alias("segment")).distinct().withColumn("n", F.lit(0).cast("long"))
    key = F.col("c_custkey").cast("long")
    source = cust.select(F.lower("c_mktsegment").alias("segment"), (key * 2).alias("n")).union(cust.select(F.initcap("c_mktsegment"), key * 2 + 1))
    return upsert_snapshot(target, source, ["segment"], case_insensitive=True, on_duplicate="latest", order_by=["n"]).state


def upsert_buckets(spark, sf_dir):
    """Customers in a bucketed table, then a source of every second key and as
    many new ones: only touched buckets are read and rewritten."""
    from ledgerflow.plans.buckets import BucketTable

    cust = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    stored = BucketTable(spark, scratch_path(spark, "customer-buckets"), cust.schema, ["c_custkey"], n_buckets=16)
    stored.upsert(cust)
    stored.upsert(cust.select((F.col("c_custkey") * 2).alias("c_custkey"), F.lower("c_mktsegment").alias("c_mktsegment")))
    return stored.read()


#: Trailing blanks and case do not count, accents do.
COLLATION = "UNICODE_CI_RTRIM"


def _spelled(name, key):
    """A name in one of three spellings that are equal under ``COLLATION``."""
    return F.when(key % 3 == 0, F.lower(name)).when(key % 3 == 1, F.concat(F.upper(name), F.lit("  "))).otherwise(name)


def collated_upsert(spark, sf_dir):
    """Customers by name, where the source spells the names in other ways."""
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    target = cust.select(F.concat(F.lit("ação "), "c_name").alias("name"), F.lit(0).cast("long").alias("n"))
    name = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("acao "), "c_name")).otherwise(F.concat(F.lit("ação "), "c_name"))
    source = cust.select(_spelled(name, F.col("c_custkey")).alias("name"), F.col("c_custkey").alias("n"))
    state = upsert_snapshot(target, source, ["name"], collation=COLLATION).state
    return state.select(F.rtrim("name").alias("name"), "n")


def dimension_load(spark, sf_dir):
    """Postal codes from a headerless file into a stored table, twice (D2):
    rows whose code is no number are rejected, not piled up."""
    from ledgerflow.plans.jobs import compute_postal_codes
    from ledgerflow.plans.tables import LakeTables

    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    code = F.when(F.col("s_suppkey") % 10 == 0, F.lit("none")).otherwise(F.col("s_suppkey").cast("string"))
    path = scratch_path(spark, "postal-codes")
    write_csv(s.select(code.alias("a"), F.lit(" sp ").alias("b"), F.concat(F.lit("city "), "s_nationkey").alias("c"), F.col("s_name").alias("d"), F.lit("x").alias("e")), path, sep=";", header=False)
    tables = LakeTables(spark, scratch_path(spark, "lake"))
    for _ in range(2):
        tables.upsert("CEP", compute_postal_codes(spark, path))
    return tables.read("CEP")


def _loaded_twice(spark, sf_dir, name, compute, df):
    """A dimension's CSV file into its stored table, twice."""
    from ledgerflow.plans.tables import LakeTables

    path = scratch_path(spark, name)
    write_csv(df, path, sep=",", header=True)
    tables = LakeTables(spark, scratch_path(spark, "lake"))
    for _ in range(2):
        tables.upsert(name, compute(spark, path))
    return tables.read(name)


def payment_terms_load(spark, sf_dir):
    """Payment terms (D3) from a file of four columns, of which three are
    kept; a term whose id is no number is rejected."""
    from ledgerflow.plans.jobs import compute_payment_terms

    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    code = F.when(F.col("p_partkey") % 10 == 0, F.lit("?")).otherwise(F.col("p_partkey").cast("string"))
    count = F.when(F.col("p_partkey") % 7 == 0, F.lit("many")).otherwise(F.col("p_size").cast("string"))
    df = p.select(code.alias("ID_CONDICAO"), F.concat(F.lit(" "), "p_name").alias("DESCRICAO"), F.lit("-").alias("ENTRADA"), count.alias("QTD_PARCELAS"))
    return _loaded_twice(spark, sf_dir, "CONDICAO_PAGAMENTO", compute_payment_terms, df)


def address_types_load(spark, sf_dir):
    """Address types (D4); a short name of more than 50 characters is rejected."""
    from ledgerflow.plans.jobs import compute_address_types

    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    short = F.when(F.col("c_custkey") % 10 == 0, F.repeat(F.lit("x"), 51)).otherwise(F.lower(F.substring("c_mktsegment", 1, 3)))
    df = c.select(F.col("c_custkey").alias("id_tipo_endereco"), F.concat("c_name", F.lit(" ")).alias("nome_tipo_endereco"), short.alias("sigla_endereco"))
    return _loaded_twice(spark, sf_dir, "TIPO_ENDERECO", compute_address_types, df)


# ---------------------------------------------------------- projections


def select_rename_distinct(spark, sf_dir):
    cust = table(spark, sf_dir, "customer", "c_nationkey", "c_mktsegment")
    return extract_entity(cust, ["c_nationkey", "c_mktsegment"], {"c_nationkey": "nation_id", "c_mktsegment": "segment"})


def trim_all_strings(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    padded = o.select(
        "o_orderkey",
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("o_orderpriority"),
        F.concat(F.lit(" "), "o_orderstatus").alias("o_orderstatus"),
    )
    return trim_strings(padded)


def upper_trim_q(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_name")
    return p.select("p_partkey", upper_trim(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("p_name"))


def canonicalize_domain(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    return o.select("o_orderkey", canonicalize("o_orderpriority", PRIORITY_MAP).alias("priority"))


def _events_with_nulls(spark, sf_dir, *extra):
    ev = table(spark, sf_dir, "events", "event_id", "event_type", *extra)
    return ev.select("event_id", *extra, F.nullif("event_type", F.lit("error")).alias("event_type"))


def fill_null_q(spark, sf_dir):
    return fill_null(_events_with_nulls(spark, sf_dir), "N/A", ["event_type"])


def try_cast_int(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_name")
    return p.select(
        "p_partkey",
        try_int(F.col("p_brand").substr(F.lit(7), F.length("p_brand"))).alias("brand_no"),
        try_int("p_name").alias("bad"),
    )


def cast_decimal(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return o.select("o_orderkey", to_decimal("o_totalprice", 10, 2).alias("total"))


def parse_date_q(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", parse_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd").alias("order_date"))


def row_ids(spark, sf_dir):
    o = with_row_ids(table(spark, sf_dir, "orders", "o_orderkey"), "row_id")
    return o.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("n_distinct"))


# ------------------------------------------------------------ filters/rules


def drop_nulls_q(spark, sf_dir):
    return drop_nulls(_events_with_nulls(spark, sf_dir), ["event_type"])


def _reasons(v, *keys: str) -> DataFrame:
    return v.rejected.select(*keys, F.col("inconsistencies").alias("inconsistency"))


def rule_null(spark, sf_dir):
    v = validate(_events_with_nulls(spark, sf_dir), [rule_not_null(["event_type"])])
    return _reasons(v, "event_id")


def rule_domain(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    v = validate(o, [rule_in_domain("o_orderpriority", PRIORITIES_OK, "invalid priority")])
    return _reasons(v, "o_orderkey")


def rule_lookup(spark, sf_dir):
    v = validate(_orders_with_bad_keys(spark, sf_dir), [rule_in_lookup("o_custkey", _customers(spark, sf_dir), "c_custkey", "invalid customer")])
    return _reasons(v, "o_orderkey")


def rule_lookup_shuffled(spark, sf_dir):
    """NULL and bad keys against a dimension that is not broadcast."""
    o = _orders_with_bad_keys(spark, sf_dir).withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")))
    v = validate(o, [rule_in_lookup("o_custkey", _customers(spark, sf_dir), "c_custkey", "invalid customer", broadcast=False)])
    return _reasons(v, "o_orderkey")


def rule_lookup_bitmap(spark, sf_dir):
    """The customer lookup of all orders by a bitmap of the customers' keys."""
    v = validate(_orders_with_bad_keys(spark, sf_dir), [rule_in_lookup("o_custkey", _customers(spark, sf_dir), "c_custkey", "invalid customer", bitmap=True)])
    return _reasons(v, "o_orderkey")


def check_references_bitmap(spark, sf_dir):
    """Lineitems without their order; the lineitems are not shuffled."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    key = F.when(F.col("l_partkey") % 11 == 0, -F.col("l_orderkey")).when(F.col("l_partkey") % 11 > 1, F.col("l_orderkey"))
    return check_references(li.select(key.alias("l_orderkey"), "l_linenumber"), ["l_orderkey"], table(spark, sf_dir, "orders", "o_orderkey"), ["o_orderkey"], bitmap=True)


def _tax_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey")
    # a 14-digit id derived from the order key; some pass the check digits
    return o.select("o_orderkey", F.lpad((F.col("o_orderkey") * 10007 + 33000167).cast("string"), 14, "0").alias("tax_id"))


def rule_check_digit(spark, sf_dir):
    return with_cnpj_valid(_tax_ids(spark, sf_dir), "tax_id", "ok")


def rule_duplicated_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    v = validate(li, [rule_duplicated()])
    return _reasons(v, "l_orderkey", "l_linenumber")


def _lineitem_quarantine(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey")
    s = li.select("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("R")).alias("flag"), (F.col("l_suppkey") % 7).alias("code"))
    rules = [rule_duplicated(), rule_not_null(["flag"]), rule_expr(F.col("code") == 3, "invalid code")]
    return validate(s, rules)


def accepted_rows(spark, sf_dir):
    return _lineitem_quarantine(spark, sf_dir).accepted


def rejected_with_reasons(spark, sf_dir):
    return _lineitem_quarantine(spark, sf_dir).rejected


def quarantine_lineitem(spark, sf_dir):
    """The full five-rule quarantine (D1) over whole lineitem rows: rejected rows."""
    from ledgerflow.plans.headline import lineitem_quarantine

    return lineitem_quarantine(spark, sf_dir).rejected


def quarantine_lineitem_accepted(spark, sf_dir):
    from ledgerflow.plans.headline import lineitem_quarantine

    return lineitem_quarantine(spark, sf_dir).accepted


def duplicates_across_loads(spark, sf_dir):
    """Lineitems in three loads, of which the second and the third bring rows
    of the first again: what all loads accept and report together."""
    from ledgerflow.plans.seen import SeenRows

    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    seen = SeenRows(spark, scratch_path(spark, "lineitem-seen"), li.columns, n_buckets=16)
    out = []
    for name, part in (("a", li.where("l_orderkey % 3 < 2")), ("b", li.where("l_orderkey % 3 > 0")), ("c", li.where("l_orderkey % 2 = 0"))):
        v = validate(part, [rule_duplicated(), rule_expr(F.col("l_quantity") > 40, "too many")], seen=seen, load=name)
        v = v.materialize(scratch_path(spark, "lineitem-load"))
        v.record()
        said = v.rejected.where("inconsistencies LIKE 'duplicated%'").withColumnRenamed("inconsistencies", "verdict")
        out += [v.accepted.withColumn("verdict", F.lit("accepted")), said.withColumn("verdict", F.lit("duplicated"))]
    return reduce(DataFrame.unionByName, out)


def published_quarantine(spark, sf_dir):
    """The lineitem quarantine published as one run and read back from it:
    accepted rows and rejected ones with their reasons."""
    from ledgerflow.plans.jobs import publish_quarantine, read_published
    from ledgerflow.plans.publish import Publication

    v = _lineitem_quarantine(spark, sf_dir)
    published = Publication(spark, scratch_path(spark, "published"))
    with published.new_run() as folder:
        publish_quarantine(v, folder)
    good = read_published(spark, published.newest(), v.accepted.schema).withColumn("reason", F.lit("accepted"))
    bad = read_csv(spark, f"{published.newest()}/rejected", header=True, sep=";", schema=v.rejected.schema)
    return good.unionByName(bad.withColumnRenamed(v.reasons_col, "reason"))


def run_history_q(spark, sf_dir):
    """Two runs of a quarantine with other rules, told by the kept history."""
    from ledgerflow.plans.history import RunHistory

    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    history = RunHistory(spark, scratch_path(spark, "history"))
    for run, label in (("first", "4-NOT SPECIFIED"), ("second", "5-LOW"), ("second", "5-LOW")):
        v = validate(o, [rule_expr(F.col("o_orderpriority") == label, "unwanted priority")])
        history.step(run, "quarantine", lambda v=v: v.stats("written", "rejected").first().asDict())
    return history.read().select("run", "step", "metric", "value")


def collect_reasons(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "user_id", "event_type")
    return collect_labels(ev, ["user_id"], "event_type", "types")


def run_stats(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    v = validate(o, [rule_expr(F.col("o_orderpriority") == "4-NOT SPECIFIED", "unspecified priority")])
    return v.stats("written", "rejected")


# ------------------------------------------------------------------- joins


def left_anti_by_id(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    return subtract_by_key(o.select("o_orderkey", "o_custkey"), o.where(F.col("o_orderstatus") == "F"), ["o_orderkey"])


def inner_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    out = resolve_keys(o, [Lookup(cust, "o_custkey", "c_custkey", take={"c_custkey": "customer_id", "c_name": "c_name"})])
    return out.select("o_orderkey", "customer_id", "c_name")


def casefold_lookup(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "event_type")
    dim = ev.select(F.upper("event_type").alias("descr"), F.length("event_type").cast("int").alias("len")).distinct()
    ev = ev.withColumn("event_type", F.when(F.col("event_id") % 10 == 0, F.concat("event_type", F.lit("?"))).otherwise(F.col("event_type")))
    out = resolve_keys(ev, [Lookup(dim, "event_type", "descr", take={"len": "len"}, casefold=True)])
    return out.select("event_id", "len")


def collated_lookup(spark, sf_dir):
    """Event types against a dimension that spells them in other ways."""
    ev = table(spark, sf_dir, "events", "event_id", "event_type")
    dim = ev.select(F.concat(F.upper("event_type"), F.lit(" ")).alias("descr"), F.length("event_type").cast("int").alias("len")).distinct()
    ev = ev.withColumn("event_type", F.when(F.col("event_id") % 10 == 0, F.concat("event_type", F.lit("?"))).otherwise(_spelled(F.col("event_type"), F.col("event_id"))))
    out = resolve_keys(ev, [Lookup(dim, "event_type", "descr", take={"len": "len"}, collation=COLLATION)])
    return out.select("event_id", "len")


def collated_unique(spark, sf_dir):
    """Market segments in three spellings are one key each."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    found = check_unique(c.select(_spelled(F.col("c_mktsegment"), F.col("c_custkey")).alias("segment")), ["segment"], collation=COLLATION)
    return found.select(F.upper(F.rtrim("segment")).alias("segment"), "n")


def two_lookups(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    cust = cust.withColumn("c_nationkey", F.when(F.col("c_custkey") % 10 == 0, F.lit(-1)).otherwise(F.col("c_nationkey")))
    nation = table(spark, sf_dir, "nation", "n_nationkey")
    out = resolve_keys(o, [
        Lookup(cust, "o_custkey", "c_custkey", take={"c_custkey": "customer_id", "c_nationkey": "c_nationkey"}),
        Lookup(nation, "c_nationkey", "n_nationkey", take={"n_nationkey": "nation_id"}, how="left"),
    ])
    return out.select("o_orderkey", "customer_id", "nation_id", F.to_date("o_orderdate").alias("order_date"))


def supplier_addresses(spark, sf_dir):
    """The address load (D6) with customers as suppliers and market segments
    as address types; some of either are unknown."""
    from ledgerflow.plans.jobs import compute_supplier_addresses

    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    staging = c.select(
        F.when(F.col("c_custkey") % 10 == 0, F.lit("unknown")).otherwise(F.col("c_name")).alias("CNPJ_FORNECEDOR"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit("unknown")).otherwise(F.lower("c_mktsegment")).alias("TIPO_ENDERECO"),
        F.col("c_custkey").cast("string").alias("NUM_ENDERECO"), F.lit("N/A").alias("COMPLEMENTO"), F.col("c_nationkey").cast("string").alias("CEP"),
    )
    kinds = c.select(F.ascii("c_mktsegment").alias("ID_TIPO_ENDERECO"), F.upper("c_mktsegment").alias("DESCRICAO")).distinct()
    return compute_supplier_addresses(staging, c.select(F.col("c_name").alias("CNPJ"), F.col("c_custkey").alias("ID_FORNECEDOR")), kinds)


def _invoice_fact(spark, sf_dir):
    from ledgerflow.plans.jobs import compute_invoices

    o = _orders_with_bad_keys(spark, sf_dir, "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    money = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    staging = o.select(
        F.col("o_orderkey").cast("string").alias("NUMERO_NF"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("DATA_EMISSAO"),
        money.alias("VALOR_NET"), F.lit("0.00").alias("VALOR_TRIBUTO"), money.alias("VALOR_TOTAL"), F.col("o_orderpriority").alias("NOME_ITEM"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("many")).otherwise(F.lit("1")).alias("QTD_ITEM"),
        F.col("o_orderstatus").alias("CONDICAO_PAGAMENTO"), F.col("o_custkey").cast("string").alias("CNPJ_FORNECEDOR"),
    )
    c = _customers(spark, sf_dir)
    suppliers = c.select(F.col("c_custkey").cast("string").alias("CNPJ"), F.col("c_custkey").alias("ID_FORNECEDOR"))
    terms = spark.createDataFrame([(1, "O", 3), (2, "F", 0)], "ID_CONDICAO int, DESCRICAO string, QTD_PARCELAS int")
    return compute_invoices(staging, suppliers, terms), terms


def invoice_fact(spark, sf_dir):
    """The invoice load (D7): supplier by inner, payment term by left lookup."""
    return _invoice_fact(spark, sf_dir)[0]


def unscheduled_invoices_q(spark, sf_dir):
    """Invoices of an unknown term (status P) or one without installments (F)."""
    from ledgerflow.plans.jobs import unscheduled_invoices

    invoices, terms = _invoice_fact(spark, sf_dir)
    counted = resolve_keys(invoices, [Lookup(terms, "ID_CONDICAO", "ID_CONDICAO", take={"QTD_PARCELAS": "QTD_PARCELAS"}, how="left")])
    return unscheduled_invoices(counted).select("NUMERO_NF", "QTD_PARCELAS")


def union_distinct_q(spark, sf_dir):
    c = table(spark, sf_dir, "customer", "c_nationkey").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("src"))
    s = table(spark, sf_dir, "supplier", "s_nationkey").select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("src"))
    return union_distinct([c, s])


# --------------------------------------------------------------- schedule


def _invoices(spark, sf_dir, *extra):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_totalprice", *extra)
    return o.select(
        "o_orderkey", *extra,
        F.to_date("o_orderdate").alias("d"),
        to_decimal("o_totalprice", 10, 2).alias("total"),
        (F.lit(1) + F.col("o_orderkey") % 4).cast("int").alias("n"),
    )


def _rounded(sched: DataFrame) -> DataFrame:
    # decimal(21,13) amount compared as a double rounded to 4 places
    return sched.withColumn("amount", F.round(F.col("amount").cast("double"), 4))


def installment_schedule_q(spark, sf_dir):
    sched = installment_schedule(_invoices(spark, sf_dir), id_col="o_orderkey", issue_date_col="d", total_col="total", count_col="n")
    return _rounded(sched)


def status_as_of(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", payment_status(F.to_date("o_orderdate"), AS_OF).alias("status"))


def schedule_with_pending_q(spark, sf_dir):
    """Both sides are whole; half of the fresh rows have stored ones."""
    o = table(spark, sf_dir, "orders", "o_orderkey")
    computed = o.select((F.col("o_orderkey") * 2).alias("o_orderkey"), F.lit(1).alias("installment_no"), F.lit(1.0).alias("amount"))
    pending = o.select("o_orderkey", F.lit(1).alias("installment_no"), F.lit(2.0).alias("amount"))
    return schedule_with_pending(computed, pending, ["o_orderkey", "installment_no"])


def _invoice_versions(spark, sf_dir):
    """Orders as invoices in a bucketed table: a first version of all, and a
    second where every fortieth has another total and as many are new."""
    from ledgerflow.plans.buckets import BucketTable

    inv = _invoices(spark, sf_dir)
    invoices = BucketTable(spark, scratch_path(spark, "invoices"), inv.schema, ["o_orderkey"], n_buckets=16)
    invoices.upsert(inv)
    some = inv.where("o_orderkey % 40 = 0")
    changed = some.withColumn("total", F.lit(1).cast("decimal(10,2)")).unionByName(some.withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    return invoices, changed


def table_changes(spark, sf_dir):
    """What an upsert changed, told from the two versions."""
    invoices, changed = _invoice_versions(spark, sf_dir)
    invoices.upsert(changed)
    return invoices.changes(1).withColumnRenamed("_change", "change")


def schedule_incremental(spark, sf_dir):
    """The schedule of all invoices, refreshed for those that changed."""
    from ledgerflow.plans.buckets import BucketTable
    from ledgerflow.plans.increment import refresh_schedule

    invoices, changed = _invoice_versions(spark, sf_dir)

    def compute(df):
        sched = installment_schedule(df, id_col="o_orderkey", issue_date_col="d", total_col="total", count_col="n")
        return refresh_status(sched, "due_date", "status", as_of=AS_OF)

    empty = compute(invoices.read([]))
    schedule = BucketTable(spark, scratch_path(spark, "schedule"), empty.schema, ["o_orderkey", "installment_no"], n_buckets=16, bucket_by=["o_orderkey"])
    terms = BucketTable(spark, scratch_path(spark, "terms"), empty.select(F.col("installment_no").alias("n")).schema, ["n"], n_buckets=1)
    for source in (None, changed):
        if source is not None:
            invoices.upsert(source)
        refresh_schedule(invoices, terms, schedule, compute, id_col="o_orderkey", term_col="n", due_col="due_date", status_col="status", paid="PAID", pending="PENDING", as_of=AS_OF)
    return _rounded(schedule.read())


def flagship_schedule(spark, sf_dir):
    """orders → canonical priority → quarantine (not-null, domain, customer
    lookup) → installment schedule of the accepted orders → status."""
    inv = _invoices(spark, sf_dir, "o_custkey", "o_orderpriority")
    customer = F.when(F.col("o_orderkey") % 10 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    inv = inv.select("o_orderkey", customer.alias("o_custkey"), "d", "total", "n", canonicalize("o_orderpriority", PRIORITY_MAP).alias("priority"))
    v = validate(inv, [
        rule_not_null(),
        rule_in_domain("priority", sorted(set(PRIORITY_MAP.values())), "invalid priority"),
        rule_in_lookup("o_custkey", _customers(spark, sf_dir), "c_custkey", "invalid customer"),
    ])
    sched = installment_schedule(v.accepted, id_col="o_orderkey", issue_date_col="d", total_col="total", count_col="n")
    return refresh_status(_rounded(sched), "due_date", "status", as_of=AS_OF)


# ------------------------------------------------------------- constraints


def surrogate_keys(spark, sf_dir):
    ids = assign_surrogate_keys(table(spark, sf_dir, "customer", "c_custkey"), "id", base=1000)
    return ids.agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.count_distinct("id").alias("n_distinct")
    )


def check_unique_q(spark, sf_dir):
    return check_unique(table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


def check_references_q(spark, sf_dir):
    return check_references(_orders_with_bad_keys(spark, sf_dir), ["o_custkey"], _customers(spark, sf_dir), ["c_custkey"])


def check_not_null_q(spark, sf_dir):
    return check_not_null(_events_with_nulls(spark, sf_dir), ["event_type"])


def check_length_q(spark, sf_dir):
    return check_length(table(spark, sf_dir, "documents", "doc_id", "text"), "text", 255, keep=["doc_id"])


QUERIES: dict[str, Query] = {
    "scan_parquet": scan_parquet,
    "scan_csv_header_strings": scan_csv_header_strings,
    "scan_csv_schema": scan_csv_schema,
    "jdbc_table_scan": jdbc_table_scan,
    "jdbc_partitioned_scan": jdbc_partitioned_scan,
    "jdbc_query_scan": jdbc_query_scan,
    "jdbc_filtered_scan": jdbc_filtered_scan,
    "jdbc_append": jdbc_append,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "upsert_snapshot": upsert_snapshot_q,
    "jdbc_upsert": jdbc_upsert,
    "merge_stats": merge_stats_q,
    "ci_upsert": ci_upsert,
    "upsert_identity": upsert_identity,
    "upsert_latest": upsert_latest,
    "ci_upsert_duplicates": ci_upsert_duplicates,
    "dimension_load": dimension_load,
    "select_rename_distinct": select_rename_distinct,
    "trim_all_strings": trim_all_strings,
    "upper_trim": upper_trim_q,
    "canonicalize_domain": canonicalize_domain,
    "fill_null": fill_null_q,
    "try_cast_int": try_cast_int,
    "cast_decimal": cast_decimal,
    "parse_date": parse_date_q,
    "row_ids": row_ids,
    "drop_nulls": drop_nulls_q,
    "rule_null": rule_null,
    "rule_domain": rule_domain,
    "rule_lookup": rule_lookup,
    "rule_lookup_shuffled": rule_lookup_shuffled,
    "rule_check_digit": rule_check_digit,
    "rule_duplicated": rule_duplicated_q,
    "accepted_rows": accepted_rows,
    "rejected_with_reasons": rejected_with_reasons,
    "quarantine_lineitem": quarantine_lineitem,
    "quarantine_lineitem_accepted": quarantine_lineitem_accepted,
    "collect_reasons": collect_reasons,
    "run_stats": run_stats,
    "left_anti_by_id": left_anti_by_id,
    "inner_lookup": inner_lookup,
    "casefold_lookup": casefold_lookup,
    "two_lookups": two_lookups,
    "supplier_addresses": supplier_addresses,
    "invoice_fact": invoice_fact,
    "unscheduled_invoices": unscheduled_invoices_q,
    "union_distinct": union_distinct_q,
    "installment_schedule": installment_schedule_q,
    "status_as_of": status_as_of,
    "schedule_with_pending": schedule_with_pending_q,
    "flagship_schedule": flagship_schedule,
    "surrogate_keys": surrogate_keys,
    "check_unique": check_unique_q,
    "check_references": check_references_q,
    "check_not_null": check_not_null_q,
    "check_length": check_length_q,
    "malformed_lines": malformed_lines_q,
    "wellformed_lines": wellformed_lines,
    "upsert_buckets": upsert_buckets,
    "collated_upsert": collated_upsert,
    "collated_lookup": collated_lookup,
    "collated_unique": collated_unique,
    "payment_terms_load": payment_terms_load,
    "address_types_load": address_types_load,
    "rule_lookup_bitmap": rule_lookup_bitmap,
    "check_references_bitmap": check_references_bitmap,
    "duplicates_across_loads": duplicates_across_loads,
    "published_quarantine": published_quarantine,
    "run_history": run_history_q,
    "table_changes": table_changes,
    "schedule_incremental": schedule_incremental,
}
