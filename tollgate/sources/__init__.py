from .lake import (
    PATTERN_DIRS, SOURCE_DIRS, SOURCES, Loaded, data_files, land_by_app, load_source,
    load_sources, pattern_out_path, pattern_root, read_many, read_parquet, read_quarantine, schema_out_path,
    source_path, source_root, with_leaf_dir, write_leaf,
)
from .reviews import (
    BRONZE_FIXTURES, REVIEW_FIXTURES, bronze_source, review_source, review_sql, silver_source,
)

__all__ = [
    "BRONZE_FIXTURES", "Loaded", "PATTERN_DIRS", "REVIEW_FIXTURES", "SOURCES", "SOURCE_DIRS", "bronze_source", "data_files", "land_by_app",
    "load_source", "load_sources", "pattern_out_path", "pattern_root",
    "read_many", "read_parquet", "read_quarantine", "review_source", "review_sql", "schema_out_path", "silver_source",
    "source_path", "source_root", "with_leaf_dir", "write_leaf",
]
