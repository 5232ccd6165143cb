from tonguemill.sources.corpus import (
    as_corpus,
    configs_at,
    data_columns,
    list_columns,
    list_configs,
    list_splits,
    name_list,
    present_columns,
    read_corpus,
    read_entries,
    read_files,
    select_configs,
    split_counts,
)
from tonguemill.sources.positions import assign_chunks, plan_chunks, position_by_key, position_in_files
from tonguemill.sources.sinks import manifest, publish_splits, stage_chunks, write_manifest, write_splits

__all__ = [
    "as_corpus", "assign_chunks", "configs_at", "data_columns", "list_columns", "list_configs", "list_splits",
    "manifest", "name_list", "plan_chunks", "position_by_key", "position_in_files", "present_columns",
    "publish_splits", "read_corpus", "read_entries", "read_files", "select_configs", "split_counts", "stage_chunks",
    "write_manifest", "write_splits",
]
