from shelfrank.sources.csv_files import (
    NA_TOKENS,
    infer_types,
    parse_columns,
    read_tables,
    scan_csv,
    scan_in_order,
    scan_present,
    write_csv,
)
from shelfrank.sources.schema import CATEGORIES, PRODUCT_SCHEMA
from shelfrank.sources.stack import union_all_by_name, with_row_id

__all__ = [
    "CATEGORIES",
    "NA_TOKENS",
    "PRODUCT_SCHEMA",
    "infer_types",
    "parse_columns",
    "read_tables",
    "scan_csv",
    "scan_in_order",
    "scan_present",
    "union_all_by_name",
    "with_row_id",
    "write_csv",
]
