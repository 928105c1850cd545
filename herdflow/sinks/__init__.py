"""Sinks: raw landing, master upsert, exports, month bundle, run log."""

from herdflow.sinks.landing import land_raw, land_sessions, landing_buckets
from herdflow.sinks.master import (append_run_log, export_csv, recover_staged, upsert_latest,
                                   with_partition, write_month_bundle)

__all__ = [
    "append_run_log", "export_csv", "land_raw", "land_sessions", "landing_buckets",
    "recover_staged", "upsert_latest", "with_partition", "write_month_bundle",
]
