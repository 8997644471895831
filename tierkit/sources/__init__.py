"""Sources and sinks: database extract, seeds, raw Parquet, layered tables, the catalog."""

from tierkit.sources.catalog import relations_by_pattern, relations_by_prefix, union_tables_matching
from tierkit.sources.coerce import coerce_bronze
from tierkit.sources.extract import JdbcSource, Split, extract_database, read_table, sample_table
from tierkit.sources.layers import (
    bronze_path,
    create_layers,
    external_table,
    materialize_table,
    materialize_view,
    promote_many,
    promote_to_silver,
    register_external,
    replace_table_as,
    scan_parquet,
    write_layer,
)
from tierkit.sources.seeds import read_seed

__all__ = [
    "JdbcSource",
    "Split",
    "bronze_path",
    "coerce_bronze",
    "create_layers",
    "external_table",
    "extract_database",
    "materialize_table",
    "materialize_view",
    "promote_many",
    "promote_to_silver",
    "read_seed",
    "read_table",
    "register_external",
    "relations_by_pattern",
    "relations_by_prefix",
    "replace_table_as",
    "sample_table",
    "scan_parquet",
    "union_tables_matching",
    "write_layer",
]
