"""Command line: run one ledger job, or all of them in dependency order.

    python -m ledgerflow all --source-path in/ --target-path out/ [--as-of 2023-09-15]
    python -m ledgerflow quarantine --source-path in/ --target-path out/
    python -m ledgerflow schedule ... --jdbc-url jdbc:... --jdbc-driver ... (password from LEDGERFLOW_DB_PASSWORD)

Counts are printed as one JSON line. The master, jars and other settings
come from ``spark-submit`` / the environment, as for any Spark application.
"""

from __future__ import annotations

import argparse
import json
import logging
import os

from ledgerflow.plans import jobs
from ledgerflow.session import build_session
from ledgerflow.sources.jdbc import JdbcConfig

RUNNERS = {
    "postal-codes": jobs.run_postal_codes,
    "payment-terms": jobs.run_payment_terms,
    "address-types": jobs.run_address_types,
    "quarantine": jobs.run_quarantine,
    "suppliers": jobs.run_suppliers,
    "supplier-addresses": jobs.run_supplier_addresses,
    "invoices": jobs.run_invoices,
    "schedule": jobs.run_schedule,
    "all": jobs.run_all,
}


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="ledgerflow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=sorted(RUNNERS))
    p.add_argument("--source-path", required=True)
    p.add_argument("--target-path", required=True)
    p.add_argument("--as-of", help="payment status reference day (default: today)")
    p.add_argument("--postal-codes-file", default="postal_codes.csv")
    p.add_argument("--buckets", type=int, help="keep lake tables in so many buckets: an upsert rewrites those it touches")
    p.add_argument("--load", help="name of this load of purchases: duplicates are found across loads")
    p.add_argument("--run", help="(all) name of this run: kept in the history, and gone on with when it stopped")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-user", default=os.environ.get("LEDGERFLOW_DB_USER"))
    p.add_argument("--jdbc-upsert-method", choices=["merge", "update_insert"], default="merge")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    jdbc = None
    if args.jdbc_url:
        jdbc = JdbcConfig(url=args.jdbc_url, driver=args.jdbc_driver, user=args.jdbc_user,
                          password=os.environ.get("LEDGERFLOW_DB_PASSWORD"))
    cfg = jobs.JobConfig(
        source_path=args.source_path, target_path=args.target_path, as_of=args.as_of,
        postal_codes_file=args.postal_codes_file, jdbc=jdbc, jdbc_upsert_method=args.jdbc_upsert_method,
        buckets=args.buckets, load=args.load,
    )
    spark = build_session(app_name=f"ledgerflow-{args.job}")
    try:
        out = jobs.run_all(spark, cfg, args.run) if args.job == "all" else RUNNERS[args.job](spark, cfg)
    finally:
        spark.stop()
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
