"""ledgerflow — purchase-ledger data quality and loading on Spark.

Everything is DataFrame code: sources read into DataFrames, functions are
Column expressions, operators compose joins / aggregations, plans wire
operators into the jobs, and sinks write distributed output.
"""

from ledgerflow.session import build_session, ensure_checkpoint_dir, scratch_path

__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path"]
