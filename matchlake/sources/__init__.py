"""Reading, decoding and writing datasets."""

from matchlake.sources.envelopes import decode_envelopes, flatten_groups, split_envelopes
from matchlake.sources.readers import (
    published,
    read_csv,
    read_dataset,
    read_json_documents,
    read_json_records,
    read_parquet,
    require_rows,
    rows_frame,
    split_csv,
    split_json_documents,
    split_json_records,
    with_landing,
)
from matchlake.sources.slices import slice_by_league
from matchlake.sources.writers import (
    counted,
    drop_versions,
    intermediate,
    land_records,
    publish,
    upsert,
    write_dataset,
    write_files,
)

__all__ = [
    "counted",
    "decode_envelopes",
    "drop_versions",
    "flatten_groups",
    "intermediate",
    "land_records",
    "publish",
    "published",
    "read_csv",
    "read_dataset",
    "read_json_documents",
    "read_json_records",
    "read_parquet",
    "require_rows",
    "rows_frame",
    "slice_by_league",
    "split_csv",
    "split_envelopes",
    "split_json_documents",
    "split_json_records",
    "upsert",
    "with_landing",
    "write_dataset",
    "write_files",
]
