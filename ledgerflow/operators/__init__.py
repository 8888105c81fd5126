"""Operators: DataFrame → DataFrame building blocks (joins, rules, upsert...)."""

from ledgerflow.operators.aggregates import collect_labels
from ledgerflow.operators.constraints import check_length, check_not_null, check_references, check_unique
from ledgerflow.operators.entities import Lookup, extract_entity, resolve_keys, union_distinct
from ledgerflow.operators.joins import lookup_join, subtract_by_key
from ledgerflow.operators.keys import assign_surrogate_keys
from ledgerflow.operators.rules import (
    Rule,
    Validation,
    rule_check_digit,
    rule_duplicated,
    rule_expr,
    rule_in_domain,
    rule_in_lookup,
    rule_not_null,
    validate,
)
from ledgerflow.operators.schedule import (
    installment_schedule,
    invalid_installment_counts,
    payment_status,
    refresh_status,
    schedule_with_pending,
)
from ledgerflow.operators.upsert import (
    DuplicateKeyError,
    UpsertResult,
    assert_unique_keys,
    keep_latest,
    merge_frames,
    merge_observation,
    merge_stats,
    upsert_snapshot,
)

__all__ = [name for name in dir() if not name.startswith("_")]
