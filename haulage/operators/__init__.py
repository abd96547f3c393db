"""DataFrame -> DataFrame steps and data checks."""

from haulage.operators.checks import (
    CheckFailed,
    Fingerprint,
    assert_ready,
    enforce_required,
    fingerprint,
    missing_counts,
    observed_metrics,
    observed_write,
    schema_differences,
    take_fingerprint,
    verify,
)
from haulage.operators.merge import merge_latest
from haulage.operators.nested import explode_records, field_of_each
from haulage.operators.preview import preview
from haulage.operators.reconcile import Reconciled, differences, reconcile, unlike_buckets, verify_rows
from haulage.operators.rows import keep_in, keep_present, with_constants
from haulage.operators.summary import distinct_count, last_write_wins, row_count

__all__ = [
    "CheckFailed",
    "Fingerprint",
    "Reconciled",
    "assert_ready",
    "differences",
    "distinct_count",
    "enforce_required",
    "explode_records",
    "field_of_each",
    "fingerprint",
    "keep_in",
    "keep_present",
    "last_write_wins",
    "merge_latest",
    "missing_counts",
    "observed_metrics",
    "observed_write",
    "preview",
    "reconcile",
    "row_count",
    "schema_differences",
    "take_fingerprint",
    "unlike_buckets",
    "verify",
    "verify_rows",
    "with_constants",
]
