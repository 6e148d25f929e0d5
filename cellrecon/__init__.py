"""Versioned wide-table reads and table reconciliation on Spark."""

from cellrecon.catalog import Catalog, CatalogError, parse_catalog
from cellrecon.operators.reads import read_table
from cellrecon.operators.reconcile import diff_tables
from cellrecon.operators.writes import append_cells, write_table
from cellrecon.options import ALL_VERSIONS, ReadOptions, Restrictive
from cellrecon.sources.cells import read_cells

__all__ = [
    "ALL_VERSIONS",
    "Catalog",
    "CatalogError",
    "ReadOptions",
    "Restrictive",
    "append_cells",
    "diff_tables",
    "parse_catalog",
    "read_cells",
    "read_table",
    "write_table",
]
