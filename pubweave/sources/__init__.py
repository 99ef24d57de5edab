from pubweave.sources.bloom import index_files, read_files_of
from pubweave.sources.json_arrays import read_json_arrays
from pubweave.sources.keyed import current_manifest, read_buckets_of, read_keyed, upsert, vacuum
from pubweave.sources.readers import (
    csv_records,
    read_articles,
    read_collection,
    read_table_csv,
)
from pubweave.sources.writers import (
    append_articles,
    current_version,
    rewrite_articles,
    write_csv,
    write_records,
)

__all__ = [
    "append_articles",
    "csv_records",
    "current_manifest",
    "current_version",
    "index_files",
    "read_articles",
    "read_buckets_of",
    "read_collection",
    "read_files_of",
    "read_json_arrays",
    "read_keyed",
    "read_table_csv",
    "rewrite_articles",
    "upsert",
    "vacuum",
    "write_csv",
    "write_records",
]
