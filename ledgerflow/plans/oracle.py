"""DuckDB oracle SQL for every catalogue query (same column names)."""

ORACLE_SQL: dict[str, str] = {
    "scan_parquet": """
SELECT c_custkey, c_name, c_nationkey FROM customer
""",
    "scan_csv_header_strings": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal FROM customer
""",
    "scan_csv_schema": """
SELECT o_orderkey, upper(trim(o_orderpriority)) AS o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
""",
    "jdbc_table_scan": """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""",
    "jdbc_partitioned_scan": """
SELECT c_custkey, c_name, c_nationkey FROM customer
""",
    "jdbc_query_scan": """
SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n INNER JOIN region r ON n.n_regionkey = r.r_regionkey
""",
    "jdbc_filtered_scan": """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'
""",
    "jdbc_append": """
SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 2 UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_regionkey >= 2
""",
    "sink_parquet_roundtrip": """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
""",
    "sink_csv_roundtrip": """
SELECT c_custkey, c_name, c_mktsegment FROM customer
""",
    "upsert_snapshot": """
SELECT coalesce(s.k, t.c_custkey) AS c_custkey, coalesce(s.seg, t.c_mktsegment) AS c_mktsegment FROM customer t FULL OUTER JOIN (SELECT c_custkey * 2 AS k, lower(c_mktsegment) AS seg FROM customer) s ON t.c_custkey = s.k
""",
    "jdbc_upsert": """
SELECT coalesce(s.k, t.s_suppkey) AS s_suppkey, coalesce(s.n, t.s_name) AS s_name FROM supplier t FULL OUTER JOIN (SELECT s_suppkey * 2 AS k, lower(s_name) AS n FROM supplier) s ON t.s_suppkey = s.k
""",
    "merge_stats": """
SELECT CASE WHEN t.c_custkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action, count(*) AS cnt FROM (SELECT c_custkey * 2 AS k FROM customer) s LEFT JOIN customer t ON t.c_custkey = s.k GROUP BY 1
""",
    "ci_upsert": """
SELECT lower(c_mktsegment) AS segment, count(*) AS n FROM customer GROUP BY 1
""",
    "upsert_identity": """
WITH m AS (SELECT max(c_custkey) AS top, min(c_custkey) AS low, count(*) AS n, count(*) FILTER (WHERE c_custkey % 2 <> 0) AS added, count(*) FILTER (WHERE c_custkey % 2 = 0) AS changed FROM customer)
SELECT n + added AS n, n + added AS n_ids, low AS min_id, top + added AS max_id, n AS n_kept, added + changed AS n_written FROM m
""",
    "upsert_latest": """
SELECT coalesce(c.c_custkey, o.k) AS c_custkey, coalesce(o.last, CAST(0 AS BIGINT)) AS last_order FROM customer c FULL OUTER JOIN (SELECT o_custkey AS k, CAST(max(o_orderkey) AS BIGINT) AS last FROM orders GROUP BY 1) o ON c.c_custkey = o.k
""",
    "ci_upsert_duplicates": """
SELECT upper(substr(max(c_mktsegment), 1, 1)) || lower(substr(max(c_mktsegment), 2)) AS segment, CAST(max(c_custkey) * 2 + 1 AS BIGINT) AS n FROM customer GROUP BY upper(c_mktsegment)
""",
    "dimension_load": """
SELECT CAST(s_suppkey AS INTEGER) AS CEP, 'SP' AS UF, 'CITY ' || s_nationkey AS CIDADE, upper(trim(s_name)) AS BAIRRO, 'X' AS LOGRADOURO FROM supplier WHERE s_suppkey % 10 <> 0
""",
    "select_rename_distinct": """
SELECT DISTINCT c_nationkey AS nation_id, c_mktsegment AS segment FROM customer
""",
    "trim_all_strings": """
SELECT o_orderkey, trim('  ' || o_orderpriority || ' ') AS o_orderpriority, trim(' ' || o_orderstatus) AS o_orderstatus FROM orders
""",
    "upper_trim": """
SELECT p_partkey, upper(trim(' ' || p_name || ' ')) AS p_name FROM part
""",
    "canonicalize_domain": """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '5-LOW' THEN 'LOW' ELSE concat(o_orderpriority, ' (invalid)') END AS priority FROM orders
""",
    "fill_null": """
SELECT event_id, coalesce(nullif(event_type, 'error'), 'N/A') AS event_type FROM events
""",
    "try_cast_int": """
SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_no, TRY_CAST(p_name AS INTEGER) AS bad FROM part
""",
    "cast_decimal": """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(10,2)) AS total FROM orders
""",
    "parse_date": """
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS order_date FROM orders
""",
    "row_ids": """
SELECT count(*) AS n, count(*) AS n_distinct FROM orders
""",
    "drop_nulls": """
SELECT event_id, event_type FROM events WHERE event_type <> 'error'
""",
    "rule_null": """
SELECT event_id, 'null column(s)' AS inconsistency FROM events WHERE nullif(event_type, 'error') IS NULL
""",
    "rule_domain": """
SELECT o_orderkey, 'invalid priority' AS inconsistency FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
""",
    "rule_lookup": """
SELECT o_orderkey, 'invalid customer' AS inconsistency FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey ELSE o_custkey END AS k FROM orders) o LEFT JOIN customer c ON o.k = c.c_custkey WHERE c.c_custkey IS NULL
""",
    "rule_lookup_shuffled": """
SELECT o_orderkey, 'invalid customer' AS inconsistency FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey ELSE o_custkey END END AS k FROM orders) o LEFT JOIN customer c ON o.k = c.c_custkey WHERE c.c_custkey IS NULL
""",
    "rule_check_digit": """
WITH d AS (SELECT o_orderkey, lpad(CAST(o_orderkey * 10007 + 33000167 AS VARCHAR), 14, '0') AS t FROM orders),
 w AS (SELECT o_orderkey, t,
  (5*CAST(substr(t,1,1) AS INT)+4*CAST(substr(t,2,1) AS INT)+3*CAST(substr(t,3,1) AS INT)+2*CAST(substr(t,4,1) AS INT)+9*CAST(substr(t,5,1) AS INT)+8*CAST(substr(t,6,1) AS INT)+7*CAST(substr(t,7,1) AS INT)+6*CAST(substr(t,8,1) AS INT)+5*CAST(substr(t,9,1) AS INT)+4*CAST(substr(t,10,1) AS INT)+3*CAST(substr(t,11,1) AS INT)+2*CAST(substr(t,12,1) AS INT)) % 11 AS r1,
  (6*CAST(substr(t,1,1) AS INT)+5*CAST(substr(t,2,1) AS INT)+4*CAST(substr(t,3,1) AS INT)+3*CAST(substr(t,4,1) AS INT)+2*CAST(substr(t,5,1) AS INT)+9*CAST(substr(t,6,1) AS INT)+8*CAST(substr(t,7,1) AS INT)+7*CAST(substr(t,8,1) AS INT)+6*CAST(substr(t,9,1) AS INT)+5*CAST(substr(t,10,1) AS INT)+4*CAST(substr(t,11,1) AS INT)+3*CAST(substr(t,12,1) AS INT)+2*CAST(substr(t,13,1) AS INT)) % 11 AS r2 FROM d)
SELECT o_orderkey, t AS tax_id, (CASE WHEN r1 < 2 THEN 0 ELSE 11 - r1 END = CAST(substr(t,13,1) AS INT) AND CASE WHEN r2 < 2 THEN 0 ELSE 11 - r2 END = CAST(substr(t,14,1) AS INT)) AS ok FROM w
""",
    "rule_duplicated": """
SELECT l_orderkey, l_linenumber, 'duplicated' AS inconsistency FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "accepted_rows": """
WITH s AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'R') AS flag, l_suppkey % 7 AS code FROM lineitem)
SELECT DISTINCT l_orderkey, l_linenumber, flag, code FROM s WHERE flag IS NOT NULL AND code <> 3
""",
    "rejected_with_reasons": """
WITH s AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'R') AS flag, l_suppkey % 7 AS code FROM lineitem),
 g AS (SELECT l_orderkey, l_linenumber, flag, code, count(*) AS n FROM s GROUP BY 1, 2, 3, 4)
SELECT l_orderkey, l_linenumber, flag, code, concat_ws(', ', CASE WHEN n > 1 THEN 'duplicated' END, CASE WHEN flag IS NULL THEN 'null column(s)' END, CASE WHEN code = 3 THEN 'invalid code' END) AS inconsistencies
FROM g WHERE n > 1 OR flag IS NULL OR code = 3
""",
    "collect_reasons": """
SELECT user_id, string_agg(event_type, ', ' ORDER BY event_type) AS types FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id
""",
    "run_stats": """
SELECT count(*) FILTER (WHERE o_orderpriority <> '4-NOT SPECIFIED') AS written, count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS rejected FROM orders
""",
    "left_anti_by_id": """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""",
    "inner_lookup": """
SELECT o.o_orderkey, c.c_custkey AS customer_id, c.c_name FROM orders o INNER JOIN customer c ON o.o_custkey = c.c_custkey
""",
    "casefold_lookup": """
WITH dim AS (SELECT DISTINCT upper(event_type) AS descr, CAST(length(event_type) AS INTEGER) AS len FROM events),
 e AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN event_type || '?' ELSE event_type END AS event_type FROM events)
SELECT e.event_id, d.len FROM e INNER JOIN dim d ON upper(e.event_type) = d.descr
""",
    "two_lookups": """
SELECT o.o_orderkey, c.c_custkey AS customer_id, n.n_nationkey AS nation_id, CAST(o.o_orderdate AS DATE) AS order_date
FROM orders o INNER JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON CASE WHEN c.c_custkey % 10 = 0 THEN -1 ELSE c.c_nationkey END = n.n_nationkey
""",
    "supplier_addresses": """
SELECT CAST(c_nationkey AS INTEGER) AS CEP, c_custkey AS ID_FORNECEDOR, CAST(ascii(c_mktsegment) AS INTEGER) AS ID_TIPO_ENDERECO, CAST(c_custkey AS VARCHAR) AS NUM_ENDERECO, 'N/A' AS COMPLEMENTO FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 7 <> 0
""",
    "invoice_fact": """
SELECT CAST(o_orderkey AS VARCHAR) AS NUMERO_NF, c.c_custkey AS ID_FORNECEDOR, CASE o_orderstatus WHEN 'O' THEN CAST(1 AS INTEGER) WHEN 'F' THEN CAST(2 AS INTEGER) END AS ID_CONDICAO, CAST(o_orderdate AS DATE) AS DATA_EMISSAO,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(10,2)) AS VALOR_NET, CAST(0 AS DECIMAL(10,2)) AS VALOR_TRIBUTO, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(10,2)) AS VALOR_TOTAL, o_orderpriority AS NOME_ITEM,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(1 AS INTEGER) END AS QTD_ITEM
FROM orders INNER JOIN customer c ON CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey ELSE o_custkey END = c.c_custkey
""",
    "unscheduled_invoices": """
SELECT CAST(o_orderkey AS VARCHAR) AS NUMERO_NF, CASE o_orderstatus WHEN 'F' THEN CAST(0 AS INTEGER) END AS QTD_PARCELAS FROM orders INNER JOIN customer c ON CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey ELSE o_custkey END = c.c_custkey WHERE o_orderstatus <> 'O'
""",
    "union_distinct": """
SELECT c_nationkey AS k, 'customer' AS src FROM customer UNION SELECT s_nationkey, 'supplier' FROM supplier
""",
    "installment_schedule": """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(10,2)) AS total, CAST(1 + o_orderkey % 4 AS INTEGER) AS n FROM orders)
SELECT o_orderkey, CAST(d + to_months(CAST(i - 1 AS INTEGER)) AS DATE) AS due_date, CAST(i AS INTEGER) AS installment_no, round(CAST(total AS DOUBLE) / n, 4) AS amount
FROM o, LATERAL (SELECT unnest(range(1, n + 1)) AS i) u
""",
    "status_as_of": """
SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1998-06-30' THEN 'PAID' ELSE 'PENDING' END AS status FROM orders
""",
    "schedule_with_pending": """
SELECT o_orderkey * 2 AS o_orderkey, 1 AS installment_no, 1.0::DOUBLE AS amount FROM orders
UNION ALL SELECT o_orderkey, 1, 2.0::DOUBLE FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey * 2 FROM orders)
""",
    "surrogate_keys": """
SELECT count(*) AS n, CAST(1001 AS BIGINT) AS min_id, 1000 + count(*) AS max_id, count(*) AS n_distinct FROM customer
""",
    "check_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""",
    "check_references": """
SELECT o_orderkey, k AS o_custkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey ELSE o_custkey END AS k FROM orders) WHERE k IS NOT NULL AND k NOT IN (SELECT c_custkey FROM customer)
""",
    "check_not_null": """
SELECT count(*) AS n FROM events WHERE nullif(event_type, 'error') IS NULL
""",
    "check_length": """
SELECT doc_id, CAST(length(text) AS INTEGER) AS len FROM documents WHERE length(text) > 255
""",
    "flagship_schedule": """
WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(10,2)) AS total,
         CAST(1 + o_orderkey % 4 AS INTEGER) AS n,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM'
              WHEN '5-LOW' THEN 'LOW' ELSE concat(o_orderpriority, ' (invalid)') END AS priority
  FROM orders),
a AS (
  SELECT DISTINCT * FROM o
  WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND d IS NOT NULL AND total IS NOT NULL AND n IS NOT NULL
    AND priority IN ('HIGH', 'LOW', 'MEDIUM')
    AND o_custkey IN (SELECT c_custkey FROM customer)),
s AS (
  SELECT o_orderkey, CAST(d + to_months(CAST(i - 1 AS INTEGER)) AS DATE) AS due_date, CAST(i AS INTEGER) AS installment_no,
         round(CAST(total AS DOUBLE) / n, 4) AS amount
  FROM a, LATERAL (SELECT unnest(range(1, n + 1)) AS i) u)
SELECT o_orderkey, due_date, installment_no, amount,
       CASE WHEN due_date <= DATE '1998-06-30' THEN 'PAID' ELSE 'PENDING' END AS status
FROM s
""",
    "quarantine_lineitem": """
WITH s AS (SELECT * REPLACE (CASE WHEN l_partkey % 50 = 0 THEN -l_partkey ELSE l_partkey END AS l_partkey), lpad(CAST(l_orderkey * 10007 + 33000167 AS VARCHAR), 14, '0') AS tax_id FROM lineitem),
g AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, tax_id, count(*) AS n FROM s GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, tax_id),
w AS (SELECT *, (5*CAST(substr(tax_id,1,1) AS INT)+4*CAST(substr(tax_id,2,1) AS INT)+3*CAST(substr(tax_id,3,1) AS INT)+2*CAST(substr(tax_id,4,1) AS INT)+9*CAST(substr(tax_id,5,1) AS INT)+8*CAST(substr(tax_id,6,1) AS INT)+7*CAST(substr(tax_id,7,1) AS INT)+6*CAST(substr(tax_id,8,1) AS INT)+5*CAST(substr(tax_id,9,1) AS INT)+4*CAST(substr(tax_id,10,1) AS INT)+3*CAST(substr(tax_id,11,1) AS INT)+2*CAST(substr(tax_id,12,1) AS INT)) % 11 AS r1, (6*CAST(substr(tax_id,1,1) AS INT)+5*CAST(substr(tax_id,2,1) AS INT)+4*CAST(substr(tax_id,3,1) AS INT)+3*CAST(substr(tax_id,4,1) AS INT)+2*CAST(substr(tax_id,5,1) AS INT)+9*CAST(substr(tax_id,6,1) AS INT)+8*CAST(substr(tax_id,7,1) AS INT)+7*CAST(substr(tax_id,8,1) AS INT)+6*CAST(substr(tax_id,9,1) AS INT)+5*CAST(substr(tax_id,10,1) AS INT)+4*CAST(substr(tax_id,11,1) AS INT)+3*CAST(substr(tax_id,12,1) AS INT)+2*CAST(substr(tax_id,13,1) AS INT)) % 11 AS r2 FROM g),
f AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, tax_id,
  n > 1 AS f_dup,
  (l_orderkey IS NULL OR l_partkey IS NULL OR l_suppkey IS NULL OR l_linenumber IS NULL OR l_quantity IS NULL OR l_extendedprice IS NULL OR l_discount IS NULL OR l_tax IS NULL OR l_returnflag IS NULL OR l_linestatus IS NULL OR l_shipdate IS NULL OR tax_id IS NULL) AS f_null,
  coalesce(l_linestatus IS NOT NULL AND l_linestatus NOT IN ('O', 'F'), false) AS f_dom,
  NOT coalesce(CASE WHEN r1 < 2 THEN 0 ELSE 11 - r1 END = CAST(substr(tax_id,13,1) AS INT)
      AND CASE WHEN r2 < 2 THEN 0 ELSE 11 - r2 END = CAST(substr(tax_id,14,1) AS INT)
      AND tax_id <> repeat(substr(tax_id,1,1), 14), false) AS f_cd,
  NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = w.l_partkey) AS f_lk
FROM w)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, tax_id, concat_ws(', ', CASE WHEN f_dup THEN 'duplicated' END, CASE WHEN f_null THEN 'null column(s)' END,
  CASE WHEN f_dom THEN 'invalid line status' END, CASE WHEN f_cd THEN 'invalid tax id' END, CASE WHEN f_lk THEN 'invalid part' END) AS inconsistencies
FROM f WHERE f_dup OR f_null OR f_dom OR f_cd OR f_lk
""",
    "quarantine_lineitem_accepted": """
WITH s AS (SELECT * REPLACE (CASE WHEN l_partkey % 50 = 0 THEN -l_partkey ELSE l_partkey END AS l_partkey), lpad(CAST(l_orderkey * 10007 + 33000167 AS VARCHAR), 14, '0') AS tax_id FROM lineitem),
g AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, tax_id, count(*) AS n FROM s GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, tax_id),
w AS (SELECT *, (5*CAST(substr(tax_id,1,1) AS INT)+4*CAST(substr(tax_id,2,1) AS INT)+3*CAST(substr(tax_id,3,1) AS INT)+2*CAST(substr(tax_id,4,1) AS INT)+9*CAST(substr(tax_id,5,1) AS INT)+8*CAST(substr(tax_id,6,1) AS INT)+7*CAST(substr(tax_id,7,1) AS INT)+6*CAST(substr(tax_id,8,1) AS INT)+5*CAST(substr(tax_id,9,1) AS INT)+4*CAST(substr(tax_id,10,1) AS INT)+3*CAST(substr(tax_id,11,1) AS INT)+2*CAST(substr(tax_id,12,1) AS INT)) % 11 AS r1, (6*CAST(substr(tax_id,1,1) AS INT)+5*CAST(substr(tax_id,2,1) AS INT)+4*CAST(substr(tax_id,3,1) AS INT)+3*CAST(substr(tax_id,4,1) AS INT)+2*CAST(substr(tax_id,5,1) AS INT)+9*CAST(substr(tax_id,6,1) AS INT)+8*CAST(substr(tax_id,7,1) AS INT)+7*CAST(substr(tax_id,8,1) AS INT)+6*CAST(substr(tax_id,9,1) AS INT)+5*CAST(substr(tax_id,10,1) AS INT)+4*CAST(substr(tax_id,11,1) AS INT)+3*CAST(substr(tax_id,12,1) AS INT)+2*CAST(substr(tax_id,13,1) AS INT)) % 11 AS r2 FROM g),
f AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, tax_id,
  n > 1 AS f_dup,
  (l_orderkey IS NULL OR l_partkey IS NULL OR l_suppkey IS NULL OR l_linenumber IS NULL OR l_quantity IS NULL OR l_extendedprice IS NULL OR l_discount IS NULL OR l_tax IS NULL OR l_returnflag IS NULL OR l_linestatus IS NULL OR l_shipdate IS NULL OR tax_id IS NULL) AS f_null,
  coalesce(l_linestatus IS NOT NULL AND l_linestatus NOT IN ('O', 'F'), false) AS f_dom,
  NOT coalesce(CASE WHEN r1 < 2 THEN 0 ELSE 11 - r1 END = CAST(substr(tax_id,13,1) AS INT)
      AND CASE WHEN r2 < 2 THEN 0 ELSE 11 - r2 END = CAST(substr(tax_id,14,1) AS INT)
      AND tax_id <> repeat(substr(tax_id,1,1), 14), false) AS f_cd,
  NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = w.l_partkey) AS f_lk
FROM w)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, tax_id FROM f WHERE NOT (f_null OR f_dom OR f_cd OR f_lk)
""",
    "malformed_lines": """
WITH l AS (
  SELECT o_orderkey AS k, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS total, CAST(o_orderdate AS DATE) AS d,
   concat_ws(';', o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 13 = 0 THEN 'much' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END) AS fields,
   CASE WHEN o_orderkey % 17 = 0 THEN 'someday' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
SELECT CASE WHEN k % 10 = 0 THEN fields WHEN k % 11 = 0 THEN fields || ';' || day || ';more' ELSE fields || ';' || day END AS line,
 CASE WHEN k % 10 = 0 OR k % 11 = 0 THEN 'wrong number of fields' ELSE 'malformed value: ' || concat_ws(', ', CASE WHEN k % 13 = 0 THEN 'total' END, CASE WHEN k % 17 = 0 THEN 'd' END) END AS reason
FROM l WHERE k % 10 = 0 OR k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0
""",
    "wellformed_lines": """
WITH l AS (
  SELECT o_orderkey AS k, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS total, CAST(o_orderdate AS DATE) AS d,
   concat_ws(';', o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 13 = 0 THEN 'much' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END) AS fields,
   CASE WHEN o_orderkey % 17 = 0 THEN 'someday' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)
SELECT k AS o_orderkey, o_orderpriority, total, d FROM l WHERE NOT (k % 10 = 0 OR k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0)
""",
    "upsert_buckets": """
SELECT coalesce(s.k, t.c_custkey) AS c_custkey, coalesce(s.seg, t.c_mktsegment) AS c_mktsegment FROM customer t FULL OUTER JOIN (SELECT c_custkey * 2 AS k, lower(c_mktsegment) AS seg FROM customer) s ON t.c_custkey = s.k
""",
    "collated_upsert": """
WITH s AS (SELECT c_custkey AS n, c_custkey % 4 = 0 AS other, CASE WHEN c_custkey % 4 = 0 THEN 'acao ' ELSE 'ação ' END || c_name AS name FROM customer)
SELECT CASE n % 3 WHEN 0 THEN lower(name) WHEN 1 THEN upper(name) ELSE name END AS name, n FROM s
UNION ALL SELECT 'ação ' || c_name, 0 FROM customer WHERE c_custkey % 4 = 0
""",
    "collated_lookup": """
SELECT event_id, CAST(length(event_type) AS INTEGER) AS len FROM events WHERE event_id % 10 <> 0
""",
    "collated_unique": """
SELECT upper(c_mktsegment) AS segment, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1
""",
    "payment_terms_load": """
SELECT CAST(p_partkey AS INTEGER) AS ID_CONDICAO, upper(trim(p_name)) AS DESCRICAO, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS INTEGER) END AS QTD_PARCELAS FROM part WHERE p_partkey % 10 <> 0
""",
    "address_types_load": """
SELECT CAST(c_custkey AS INTEGER) AS ID_TIPO_ENDERECO, upper(trim(c_name)) AS DESCRICAO, upper(substr(c_mktsegment, 1, 3)) AS SIGLA FROM customer WHERE c_custkey % 10 <> 0
""",
    "rule_lookup_bitmap": """
SELECT o_orderkey, 'invalid customer' AS inconsistency FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN -o_custkey ELSE o_custkey END AS k FROM orders) o LEFT JOIN customer c ON o.k = c.c_custkey WHERE c.c_custkey IS NULL
""",
    "check_references_bitmap": """
WITH l AS (SELECT CASE WHEN l_partkey % 11 = 0 THEN -l_orderkey WHEN l_partkey % 11 > 1 THEN l_orderkey END AS l_orderkey, l_linenumber FROM lineitem)
SELECT l.l_orderkey, l.l_linenumber FROM l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_orderkey IS NOT NULL AND o.o_orderkey IS NULL
""",
    "duplicates_across_loads": """
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem),
 a AS (SELECT * FROM l WHERE l_orderkey % 3 < 2 UNION ALL SELECT * FROM l WHERE l_orderkey % 3 > 0 UNION ALL SELECT * FROM l WHERE l_orderkey % 2 = 0),
 g AS (SELECT l_orderkey, l_linenumber, l_quantity, count(*) AS n FROM a GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_quantity, 'accepted' AS verdict FROM g WHERE l_quantity <= 40
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, 'duplicated' FROM g WHERE n > 1
""",
    "published_quarantine": """
WITH s AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'R') AS flag, l_suppkey % 7 AS code FROM lineitem),
 g AS (SELECT l_orderkey, l_linenumber, flag, code, count(*) AS n FROM s GROUP BY 1, 2, 3, 4)
SELECT l_orderkey, l_linenumber, flag, code, 'accepted' AS reason FROM g WHERE flag IS NOT NULL AND code <> 3
UNION ALL SELECT l_orderkey, l_linenumber, flag, code, concat_ws(', ', CASE WHEN n > 1 THEN 'duplicated' END, CASE WHEN flag IS NULL THEN 'null column(s)' END, CASE WHEN code = 3 THEN 'invalid code' END)
FROM g WHERE n > 1 OR flag IS NULL OR code = 3
""",
    "run_history": """
WITH r AS (SELECT 'first' AS run, '4-NOT SPECIFIED' AS p UNION ALL SELECT 'second', '5-LOW')
SELECT run, 'quarantine' AS step, 'written' AS metric, count(*) AS value FROM orders, r WHERE o_orderpriority <> p GROUP BY run
UNION ALL SELECT run, 'quarantine', 'rejected', count(*) FROM orders, r WHERE o_orderpriority = p GROUP BY run
""",
    "table_changes": """
SELECT o_orderkey, 'update' AS change FROM orders WHERE o_orderkey % 40 = 0 AND CAST(o_totalprice AS DECIMAL(10,2)) <> 1
UNION ALL SELECT -o_orderkey - 1, 'insert' FROM orders WHERE o_orderkey % 40 = 0
""",
    "schedule_incremental": """
WITH v AS (
 SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 40 = 0 THEN 1 ELSE CAST(o_totalprice AS DECIMAL(10,2)) END AS total, CAST(1 + o_orderkey % 4 AS INTEGER) AS n FROM orders
 UNION ALL SELECT -o_orderkey - 1, CAST(o_orderdate AS DATE), CAST(o_totalprice AS DECIMAL(10,2)), CAST(1 + o_orderkey % 4 AS INTEGER) FROM orders WHERE o_orderkey % 40 = 0)
SELECT o_orderkey, CAST(d + to_months(CAST(i - 1 AS INTEGER)) AS DATE) AS due_date, CAST(i AS INTEGER) AS installment_no, round(CAST(total AS DOUBLE) / n, 4) AS amount,
 CASE WHEN d + to_months(CAST(i - 1 AS INTEGER)) <= DATE '1998-06-30' THEN 'PAID' ELSE 'PENDING' END AS status
FROM v, unnest(range(1, n + 1)) AS u(i)
""",
}
