"""Readers: files, partitions, manifests, audits."""

from .files import (
    file_inventory,
    land_by_filename_date,
    load_errors,
    read_csv,
    read_jsonl,
    read_merged,
    read_partitioned,
    read_prefix,
    read_reference,
    read_table,
    register_external,
    scan_cost,
    schema_drift,
)
from .footers import parquet_footers, parquet_type_audit
from .manifest import ManifestError, manifest_check, read_manifest
from .partitions import partition_gaps, projected_paths, projected_scan, pruned_scan

__all__ = [
    "ManifestError",
    "file_inventory",
    "land_by_filename_date",
    "load_errors",
    "manifest_check",
    "parquet_footers",
    "parquet_type_audit",
    "partition_gaps",
    "projected_paths",
    "projected_scan",
    "pruned_scan",
    "read_csv",
    "read_jsonl",
    "read_manifest",
    "read_merged",
    "read_partitioned",
    "read_prefix",
    "read_reference",
    "read_table",
    "register_external",
    "scan_cost",
    "schema_drift",
]
