"""Writers: appends, partition overwrites, tables, views and snapshots."""

from .cluster import clustered_table
from .compact import Compaction, compact_table, remove_replaced
from .dealt import DealtTable, aggregate_dealt, deal_table, dealt_table, join_dealt
from .files import append, append_partitioned, overwrite_partitions, publish_snapshot, replace_partitions, stored
from .tables import (
    add_rows,
    bucketed_table,
    describe_table,
    insert_new,
    refresh_view,
    reload_staging,
    save_table,
    upsert_partitions,
    upsert_rows,
)
from .versions import VersionedTable, changed_buckets, read_version, save_version, version_feed
from .views import KeptView, apply_changes, apply_sums, build_view, by_group, coarser, read_view, summed, version_of

__all__ = [
    "Compaction",
    "DealtTable",
    "KeptView",
    "VersionedTable",
    "add_rows",
    "aggregate_dealt",
    "append",
    "append_partitioned",
    "apply_changes",
    "apply_sums",
    "bucketed_table",
    "build_view",
    "by_group",
    "changed_buckets",
    "clustered_table",
    "coarser",
    "compact_table",
    "deal_table",
    "dealt_table",
    "describe_table",
    "insert_new",
    "join_dealt",
    "overwrite_partitions",
    "publish_snapshot",
    "read_version",
    "read_view",
    "refresh_view",
    "reload_staging",
    "remove_replaced",
    "replace_partitions",
    "save_table",
    "save_version",
    "stored",
    "summed",
    "upsert_partitions",
    "upsert_rows",
    "version_feed",
    "version_of",
]
