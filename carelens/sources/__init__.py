"""Scans, file discovery, intake manifests and sinks."""

from carelens.sources.csv import normalize_missing, read_csv, read_csv_tolerant
from carelens.sources.discovery import latest_snapshot_path, list_files, read_discovered, read_latest
from carelens.sources.intake import classify_intake, intake, resolve_shortcuts
from carelens.sources.sinks import write_bronze, write_csv, write_gold, write_snapshot

__all__ = [
    "normalize_missing", "read_csv", "read_csv_tolerant",
    "latest_snapshot_path", "list_files", "read_discovered", "read_latest",
    "classify_intake", "intake", "resolve_shortcuts",
    "write_bronze", "write_csv", "write_gold", "write_snapshot",
]
