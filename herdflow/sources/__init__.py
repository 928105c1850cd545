"""Scans and sources: landed blobs, session documents, herd snapshots, master reads."""

from herdflow.sources.blobs import explode_lines, parse_blobs, read_raw_blobs, read_raw_csv
from herdflow.sources.master import load_window, read_master, tag_and_union
from herdflow.sources.scan import read_parquet
from herdflow.sources.sessions import (deletable, flatten_envelope, flatten_sessions,
                                       new_sessions, parse_envelope, read_sessions)
from herdflow.sources.snapshots import (apply_header_mapping, asof_join, load_snapshot,
                                        pick_snapshot, resolve_herd, resolve_snapshot_date,
                                        snapshot_date)

__all__ = [
    "apply_header_mapping", "asof_join", "deletable", "explode_lines", "flatten_envelope",
    "flatten_sessions", "load_snapshot", "load_window", "new_sessions", "parse_blobs",
    "parse_envelope", "pick_snapshot", "read_master", "read_raw_blobs", "read_raw_csv",
    "read_parquet", "read_sessions", "resolve_herd", "resolve_snapshot_date", "snapshot_date",
    "tag_and_union",
]
