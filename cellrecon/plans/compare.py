"""The two comparison jobs, end to end.

``compare_declared`` reads the same catalog from two cell tables and reports differing rows;
``compare_discovered`` needs no schema and reports on whatever columns a family has. As programs::

    python -m cellrecon.plans.compare declared   --table1 P1 --table2 P2 --catalog C.json --out O
    python -m cellrecon.plans.compare discovered --table1 P1 --table2 P2 --family F --out O
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession

from cellrecon.catalog import Catalog, parse_catalog
from cellrecon.operators.reads import cells_per_row
from cellrecon.operators.reconcile import (
    compare_row_counts,
    diff_by_cell_count,
    diff_family,
    differing_pairs,
    stored_diff_columns,
    stored_diff_counts,
    stored_diff_rows,
    stored_pairs,
)
from cellrecon.operators.scans import select_time
from cellrecon.options import ReadOptions, Restrictive
from cellrecon.session import scratch_scope, written
from cellrecon.sources.cells import read_cells
from cellrecon.sources.documents import write_diff_documents


@dataclass(frozen=True)
class DeclaredComparison:
    rows: DataFrame
    columns: DataFrame
    summary: DataFrame


@dataclass(frozen=True)
class DiscoveredComparison:
    row_counts: DataFrame
    column_counts: tuple[DataFrame, DataFrame]
    documents: DataFrame
    cells: DataFrame


def compare_declared(
    cells1: DataFrame,
    cells2: DataFrame,
    catalog: Catalog,
    options: ReadOptions = ReadOptions(),
    null_safe: bool = True,
) -> DeclaredComparison:
    """Differing rows, differing columns and totals of two copies of one table.

    Both tables are read once and aggregated together: the differing pairs are written out, decoded only then, and
    the totals are observed on the way. Rows and columns then come from the pairs.
    """
    totals = Observation()
    pairs = stored_pairs(cells1, cells2, catalog, options)
    observed = pairs.observe(totals, *stored_diff_counts(pairs))
    differing = written(differing_pairs(observed, catalog, null_safe), "differences")
    changed = differing.filter("in_1 AND in_2").count()
    counts = {n: totals.get[n] for n in ("rows1", "rows2", "only_in_1", "only_in_2")}
    counts |= {"changed": changed, "same": totals.get["both"] - changed}
    summary = cells1.sparkSession.createDataFrame(
        [tuple(counts.values())], ", ".join(f"{n} bigint" for n in counts)
    )
    return DeclaredComparison(
        rows=stored_diff_rows(differing, catalog), columns=stored_diff_columns(differing, catalog), summary=summary
    )


def compare_discovered(
    cells1: DataFrame, cells2: DataFrame, family: str, options: ReadOptions = ReadOptions(), parts: int = 1
) -> DiscoveredComparison:
    """Row counts, column counts per key, mismatched keys as documents, and every cell difference."""
    cells1, cells2 = (select_time(c, options) for c in (cells1, cells2))
    counts = tuple(cells_per_row(c.filter(c["family"] == family)) for c in (cells1, cells2))
    return DiscoveredComparison(
        row_counts=compare_row_counts(*counts),
        column_counts=counts,
        documents=diff_by_cell_count(cells1, cells2, family, parts),
        cells=diff_family(cells1, cells2, family),
    )


def discovered_family(catalog: Catalog) -> str:
    """The one family that a catalog has as a map of its columns."""
    families = {c.family for c in catalog.value_columns if c.is_dynamic}
    if len(families) != 1:
        raise ValueError(f"a catalog to discover columns by has a map of one family, not of {sorted(families)}")
    return families.pop()


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cellrecon.plans.compare")
    parser.add_argument("mode", choices=["declared", "discovered"])
    parser.add_argument("--table1", required=True, help="path of the first cell table")
    parser.add_argument("--table2", required=True, help="path of the second cell table")
    parser.add_argument("--catalog", help="file with the JSON catalog (declared; discovered: one with a map of a whole family)")
    parser.add_argument("--family", help="column family to compare (discovered, if no catalog names it)")
    parser.add_argument("--min-ts", type=int, help="first version time, epoch milliseconds")
    parser.add_argument("--max-ts", type=int, help="version time to stop before")
    parser.add_argument("--timestamp", type=int, help="one exact version time, epoch milliseconds")
    parser.add_argument(
        "--restrictive", choices=[r.value for r in Restrictive], default=Restrictive.COLUMN.value,
        help="which cells make a key count as a row (declared)",
    )
    parser.add_argument("--ignore-nulls", action="store_true", help="a value missing on one side is no difference (declared)")
    parser.add_argument("--parts", type=int, default=1, help="documents for each mismatched key (discovered)")
    parser.add_argument("--out", required=True, help="folder for the results")
    arguments = parser.parse_args(argv)
    if arguments.mode == "declared" and not arguments.catalog:
        parser.error("declared needs --catalog")
    if arguments.mode == "discovered" and not (arguments.family or arguments.catalog):
        parser.error("discovered needs --family or --catalog")
    return arguments


def main(argv: Sequence[str] | None = None) -> None:
    arguments = _arguments(argv)
    spark = SparkSession.builder.appName("compare-cells").getOrCreate()
    cells1, cells2 = (read_cells(spark, p) for p in (arguments.table1, arguments.table2))
    options = ReadOptions(
        timestamp=arguments.timestamp,
        min_ts=arguments.min_ts,
        max_ts=arguments.max_ts,
        restrictive=Restrictive(arguments.restrictive),
    )
    with scratch_scope(spark):
        if arguments.mode == "declared":
            catalog = parse_catalog(Path(arguments.catalog).read_text())
            found = compare_declared(cells1, cells2, catalog, options, null_safe=not arguments.ignore_nulls)
            found.rows.write.mode("overwrite").parquet(f"{arguments.out}/rows")
            found.columns.write.mode("overwrite").parquet(f"{arguments.out}/columns")
            found.summary.show()
        else:
            family = arguments.family or discovered_family(parse_catalog(Path(arguments.catalog).read_text()))
            found = compare_discovered(cells1, cells2, family, options, arguments.parts)
            found.row_counts.show()
            found.cells.write.mode("overwrite").parquet(f"{arguments.out}/cells")
            write_diff_documents(found.documents, arguments.out)


if __name__ == "__main__":
    main()
