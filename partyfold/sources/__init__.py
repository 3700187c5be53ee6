"""Datasets on shared storage: scans, replacement, copies, snapshots, backups, manifest."""

from partyfold.sources.bucketed import bucket_spec, co_located, write_bucketed
from partyfold.sources.checked_load import CheckedLoad, checked_load, read_accepted, read_rejected
from partyfold.sources.files import Files, scratch, scratch_dir
from partyfold.sources.manifest import (
    append_manifest,
    committed_batches,
    compact_manifest,
    decode_messages,
    load_events,
    read_manifest,
)
from partyfold.sources.partitions import apply_to_partitions, touched_folders, write_partitions
from partyfold.sources.products import (
    read_by_product,
    read_product_list,
    write_by_product,
)
from partyfold.sources.tables import (
    adjust_after_pin,
    adjust_after_snapshot,
    backup_layer,
    copy_dataset,
    layer_datasets,
    overwrite_dataset,
    partition_columns,
    pin_version,
    pinned_versions,
    read_dataset,
    read_pinned,
    read_table,
    replace_load,
    read_whole,
    require_columns,
    require_types,
    snapshot,
    table_path,
    unpin_version,
)

__all__ = [
    "CheckedLoad",
    "Files",
    "adjust_after_pin",
    "adjust_after_snapshot",
    "append_manifest",
    "apply_to_partitions",
    "backup_layer",
    "bucket_spec",
    "checked_load",
    "co_located",
    "committed_batches",
    "compact_manifest",
    "copy_dataset",
    "decode_messages",
    "layer_datasets",
    "load_events",
    "overwrite_dataset",
    "partition_columns",
    "pin_version",
    "pinned_versions",
    "read_accepted",
    "read_by_product",
    "read_dataset",
    "read_manifest",
    "read_pinned",
    "read_product_list",
    "read_rejected",
    "read_table",
    "read_whole",
    "replace_load",
    "require_columns",
    "require_types",
    "scratch",
    "scratch_dir",
    "snapshot",
    "table_path",
    "touched_folders",
    "unpin_version",
    "write_bucketed",
    "write_by_product",
    "write_partitions",
]
