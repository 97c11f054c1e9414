from roomtide.sources.readers import (
    Ranges,
    dated_path,
    read_delimited,
    read_jdbc,
    read_lines,
    read_named_fields,
    read_parquet,
    read_snapshot,
    snapshot_key,
)
from roomtide.sources.versions import BUCKETS, manifest, prune, publish_version, read_version, versions
from roomtide.sources.writers import write_delimited, write_parquet, write_partitioned

__all__ = [
    "BUCKETS", "Ranges", "dated_path", "manifest", "prune", "publish_version", "read_delimited", "read_jdbc", "read_lines",
    "read_named_fields", "read_parquet", "read_snapshot", "read_version", "snapshot_key", "versions",
    "write_delimited", "write_parquet", "write_partitioned",
]
