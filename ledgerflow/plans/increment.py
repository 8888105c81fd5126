"""The installment schedule recomputed for what changed.

The schedule notes the versions of the tables it was computed from. A refresh
takes the change set of the invoices since then (only the buckets that have
moved are read), the invoices whose payment term changed, and the stored rows
that were pending and have come due; it recomputes the schedules of the first
two, renews the status of the last, and puts them in the place of these
invoices' old rows, rewriting their buckets alone. Everything else stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.joins import lookup_join
from ledgerflow.operators.schedule import refresh_status
from ledgerflow.plans import claims
from ledgerflow.plans.buckets import BucketTable
from ledgerflow.session import remove_path, scratch_path


def _noted(schedule: BucketTable) -> tuple[int, int]:
    """The versions (invoices, terms) that the schedule was last computed from."""
    names = claims.children(schedule.spark, f"{schedule.path}/_sources", dirs=False)
    return max((tuple(int(x) for x in n.split(".")) for n in names), default=(0, 0))


def changed_invoices(invoices: BucketTable, since: int, until: int, id_col: str) -> DataFrame:
    """Ids of the invoices that differ between two versions."""
    return invoices.changes(since, until, keys=[id_col]).select(id_col).where(F.col(id_col).isNotNull())


def refresh_schedule(
    invoices: BucketTable,
    terms: BucketTable,
    schedule: BucketTable,
    compute: Callable[[DataFrame], DataFrame],
    *,
    id_col: str,
    term_col: str,
    due_col: str,
    status_col: str,
    paid: str,
    pending: str,
    as_of=None,
) -> dict[str, int]:
    """Bring ``schedule`` (bucketed by ``id_col``) up to date. ``compute``
    makes the schedule rows, status included, of some invoices. Returns the
    counts of schedule rows and of invoices looked at; a second call without
    changes writes nothing."""
    spark = schedule.spark
    seen_invoices, seen_terms = _noted(schedule)
    at_invoices, at_terms = max(invoices.versions(), default=0), max(terms.versions(), default=0)
    current = invoices.read()
    parts = [changed_invoices(invoices, seen_invoices, at_invoices, id_col)]
    if at_terms != seen_terms and seen_invoices:  # at first every invoice is new anyway
        moved_terms = terms.changes(seen_terms, at_terms, keys=[term_col]).select(term_col)
        parts.append(lookup_join(current, moved_terms, [term_col], [term_col], "left_semi").select(id_col))
    changed_folder, due_folder = scratch_path(spark, "schedule-changed"), scratch_path(spark, "schedule-due")
    ids = parts[0]
    for p in parts[1:]:
        ids = ids.unionByName(p)
    ids.distinct().write.parquet(changed_folder)
    changed = spark.read.schema(ids.schema).parquet(changed_folder)
    stored = schedule.read()
    ref = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    due = stored.where((F.col(status_col) == pending) & (F.col(due_col) <= ref)).select(id_col).distinct()
    due = lookup_join(due, changed, [id_col], [id_col], "left_anti")
    due.write.parquet(due_folder)
    due = spark.read.schema(due.schema).parquet(due_folder)
    try:
        # changed invoices lie in moved buckets, unless their term changed
        moved = None if len(parts) > 1 else invoices.moved(seen_invoices, at_invoices)
        touched = lookup_join(invoices.read(moved), changed, [id_col], [id_col], "left_semi")
        fresh = compute(touched)
        renewed = lookup_join(stored.select(*fresh.columns), due, [id_col], [id_col], "left_semi")
        renewed = refresh_status(renewed, due_col, status_col, as_of=as_of, paid=paid, pending=pending)
        counts = schedule.replace(changed.unionByName(due), fresh.unionByName(renewed))
        counts["invoices"] = changed.count() + due.count()
    finally:
        remove_path(spark, changed_folder)
        remove_path(spark, due_folder)
    claims.create(spark, f"{schedule.path}/_sources/{at_invoices}.{at_terms}")
    return counts
