from strata.sources.commits import CommitConflictError, LayerCommit, clean_layer
from strata.sources.json_array import read_json_array
from strata.sources.json_docs import (CORRUPT_COLUMN, dated_name, dated_path, raw_json_columns, read_json_documents,
                                      with_corrupt_column)
from strata.sources.landing import land_pages, read_pages
from strata.sources.layout import read_clustered, write_clustered
from strata.sources.paged import PagedSource, land_paged, read_paged, stream_paged
from strata.sources.snapshots import restore, snapshot
from strata.sources.tables import (append_table, create_if_absent, current_version, layer_path,
                                   overwrite_partitions, publish_versions, read_table, replace_table, write_day)

__all__ = [
    "CommitConflictError", "LayerCommit", "clean_layer", "CORRUPT_COLUMN", "with_corrupt_column", "write_day", "dated_name", "dated_path", "raw_json_columns", "read_json_array", "read_json_documents", "land_pages", "read_pages",
    "read_clustered", "write_clustered", "PagedSource", "land_paged", "read_paged", "stream_paged",
    "restore", "snapshot", "append_table", "create_if_absent", "current_version", "layer_path",
    "overwrite_partitions", "publish_versions", "read_table", "replace_table",
]
