"""Print the physical plan tree and scan details of chosen queries.

usage: python tools/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DEFAULT = ["accepted_rows", "rejected_with_reasons", "rule_lookup", "rule_check_digit", "installment_schedule",
           "upsert_snapshot", "two_lookups", "check_references", "collect_reasons", "jdbc_filtered_scan", "flagship_schedule"]


def summary(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, rest = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
    keep = []
    for block in rest.split("\n\n"):
        lines = block.strip().splitlines()
        if not lines:
            continue
        head = lines[0]
        if "Scan" in head or "Exchange" in head or "Join" in head:
            keep.append(head)
            keep += ["  " + ln for ln in lines[1:] if ln.startswith(("ReadSchema", "PushedFilters", "Arguments", "Join type", "Left keys", "Right keys"))]
    return tree.strip() + "\n\n" + "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    from ledgerflow.plans.catalog import QUERIES
    from ledgerflow.plans import headline
    from ledgerflow.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    extra = {"quarantine_lineitem(rejected)": lambda s, d: headline.lineitem_quarantine(s, d).rejected,
             "upsert_orders": headline.orders_upsert}
    for name in names:
        fn = QUERIES.get(name) or extra.get(name)
        print(f"### {name}\n```\n{summary(fn(spark, sf_dir))}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
