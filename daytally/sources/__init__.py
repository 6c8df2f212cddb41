"""Where rows come from: files, landed documents and listings."""

from daytally.sources.csv_tables import read_csv_layout, read_csv_text, split_bad_rows, union_layouts
from daytally.sources.documents import (
    bad_document_rows,
    bad_rows,
    document_maps,
    document_status,
    explode_maps,
    fetch_documents,
    good_rows,
    landed_rows,
    newest_offered,
    offered_at,
    parse_documents,
    read_documents,
)
from daytally.sources.listings import clean_listing, csv_lines, parse_csv_lines, symbol_universe
from daytally.sources.tables import read_table, sql_view, table_exists

__all__ = [
    "bad_document_rows", "bad_rows", "clean_listing", "csv_lines", "document_maps", "document_status", "explode_maps",
    "fetch_documents", "good_rows", "landed_rows", "newest_offered", "offered_at", "parse_csv_lines", "parse_documents", "read_csv_layout", "read_csv_text", "read_documents",
    "read_table", "split_bad_rows",
    "sql_view", "symbol_universe", "table_exists", "union_layouts",
]
