"""Queries: joins, counts and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellrecon import parse_catalog
from cellrecon.operators import reads, reconcile
from cellrecon.session import scratch_path
from cellrecon.sources.documents import read_diff_documents, write_diff_documents
from queryset.registry import query
from queryset.tables import (
    EVENTS_1,
    EVENTS_2,
    ORDER_CATALOG,
    ORDERS_1,
    ORDERS_2,
    customer_sides,
    order_cells,
    sql,
    tagged_cells,
    tagged_side,
)

COLUMNS = ["custkey", "status", "price", "priority"]

_PICKED = ", ".join(
    f"CASE WHEN a.custkey IS NOT NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in COLUMNS
)


def _diff_sql(differs: str) -> str:
    names = " || ".join(
        f"CASE WHEN a.{c} {differs} b.{c} THEN '{c} ' ELSE '' END" for c in COLUMNS[1:]
    )
    return sql(
        f"""SELECT * FROM (SELECT {_PICKED},
            CASE WHEN a.custkey IS NULL THEN 'New row in DataFrame 2'
                 WHEN b.custkey IS NULL THEN 'New row in DataFrame 1' ELSE {names} END AS Diff
        FROM customers1 a FULL JOIN customers2 b ON a.custkey = b.custkey) WHERE Diff <> ''""",
        "customers1",
        "customers2",
    )


@query("diff_tables", _diff_sql("<>"))
def diff_tables(spark, d):
    return reconcile.diff_tables(*customer_sides(spark, d), "custkey", null_safe=False)


@query("diff_tables_null_safe", _diff_sql("IS DISTINCT FROM"))
def diff_tables_null_safe(spark, d):
    return reconcile.diff_tables(*customer_sides(spark, d), "custkey")


def _order_pair(spark, d):
    """Cells of both sides; they are aggregated together, and values compared before they are typed."""
    return [order_cells(spark, d, times) for times in (ORDERS_1, ORDERS_2)]


@query(
    "diff_columns",
    sql(
        " UNION ALL ".join(
            f"""SELECT a.custkey AS custkey, '{c}' AS "column", CAST(a.{c} AS VARCHAR) AS value1,
            CAST(b.{c} AS VARCHAR) AS value2 FROM customers1 a JOIN customers2 b
            ON a.custkey = b.custkey WHERE a.{c} IS DISTINCT FROM b.{c}"""
            for c in COLUMNS[1:]
        ),
        "customers1",
        "customers2",
    ),
)
def diff_columns(spark, d):
    return reconcile.diff_encoded_columns(*_order_pair(spark, d), parse_catalog(ORDER_CATALOG))


_CHANGED = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in COLUMNS[1:])
_BOTH = "a.custkey IS NOT NULL AND b.custkey IS NOT NULL"


@query(
    "diff_summary",
    sql(
        f"""SELECT count(a.custkey) AS rows1, count(b.custkey) AS rows2,
            count(*) FILTER (WHERE b.custkey IS NULL) AS only_in_1,
            count(*) FILTER (WHERE a.custkey IS NULL) AS only_in_2,
            count(*) FILTER (WHERE {_BOTH} AND ({_CHANGED})) AS changed,
            count(*) FILTER (WHERE {_BOTH} AND NOT ({_CHANGED})) AS same
        FROM customers1 a FULL JOIN customers2 b ON a.custkey = b.custkey""",
        "customers1",
        "customers2",
    ),
)
def diff_summary(spark, d):
    return reconcile.diff_encoded_summary(*_order_pair(spark, d), parse_catalog(ORDER_CATALOG))


@query(
    "left_outer_pair",
    sql(
        "SELECT "
        + ", ".join(f"{s}.{c} AS {c}_{n}" for n, s in ((1, "a"), (2, "b")) for c in COLUMNS)
        + " FROM customers1 a LEFT JOIN customers2 b ON a.custkey = b.custkey",
        "customers1",
        "customers2",
    ),
)
def left_outer_pair(spark, d):
    return reconcile.left_outer_pair(*customer_sides(spark, d), "custkey")


@query(
    "rename_all",
    sql(
        """SELECT a.custkey AS key1, a.status AS first_status, b.status AS second_status
        FROM customers1 a JOIN customers2 b ON a.custkey = b.custkey""",
        "customers1",
        "customers2",
    ),
)
def rename_all(spark, d):
    first, second = customer_sides(spark, d)
    joined = first.select("custkey", "status").join(second.select("custkey", "status"), "custkey")
    return reconcile.rename_all(joined, "key1", "first_status", "second_status")


@query(
    "pick_present_side",
    sql(
        f"SELECT {_PICKED} FROM customers1 a FULL JOIN customers2 b ON a.custkey = b.custkey",
        "customers1",
        "customers2",
    ),
)
def pick_present_side(spark, d):
    first, second = customer_sides(spark, d)
    joined = reconcile.join_sides(first, second, "custkey", "full_outer")
    return joined.select(*reconcile.pick_present_side(joined, "custkey", COLUMNS))


@query(
    "compare_row_counts",
    sql(
        """SELECT n1, n2, n1 = n2 AS same FROM (SELECT (SELECT count(*) FROM customers1) AS n1,
        (SELECT count(*) FROM customers2) AS n2)""",
        "customers1",
        "customers2",
    ),
)
def compare_row_counts(spark, d):
    return reconcile.compare_row_counts(*customer_sides(spark, d))


@query(
    "column_except",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", value FROM (
            SELECT CAST({c} AS VARCHAR) AS value FROM customers1
            EXCEPT SELECT CAST({c} AS VARCHAR) AS value FROM customers2)"""
            for c in COLUMNS
        ),
        "customers1",
        "customers2",
    ),
)
def column_except(spark, d):
    return reconcile.column_except(*customer_sides(spark, d))


@query(
    "diff_cells",
    sql(
        """SELECT * FROM (SELECT coalesce(a.row_key, b.row_key) AS row_key,
            coalesce(a.qualifier, b.qualifier) AS qualifier, a.value AS value1, b.value AS value2,
            CASE WHEN a.row_key IS NULL THEN 'New row in DataFrame 2'
                 WHEN b.row_key IS NULL THEN 'New row in DataFrame 1'
                 WHEN a.value IS DISTINCT FROM b.value THEN 'value ' END AS Diff
        FROM tagged1 a FULL JOIN tagged2 b
        ON a.row_key = b.row_key AND a.qualifier = b.qualifier) WHERE Diff IS NOT NULL""",
        "tagged1",
        "tagged2",
    ),
)
def diff_cells(spark, d):
    return reconcile.diff_cells(tagged_side(spark, d, EVENTS_1), tagged_side(spark, d, EVENTS_2))


_COUNTS = "SELECT row_key, count(*) AS n FROM {t} GROUP BY row_key"
_MISMATCH = """SELECT a.row_key AS rowkey1, a.n AS count1, b.row_key AS rowkey2, b.n AS count2
    FROM counts1 a JOIN counts2 b ON a.row_key = b.row_key AND a.n <> b.n"""
_COUNT_TABLES = {"counts1": _COUNTS.format(t="tagged1"), "counts2": _COUNTS.format(t="tagged2")}


def _tagged_pair(spark, d):
    return tagged_cells(spark, d, EVENTS_1), tagged_cells(spark, d, EVENTS_2)


def _mismatches(spark, d):
    first, second = (reads.cells_per_row(c) for c in _tagged_pair(spark, d))
    return reconcile.count_mismatch_join(first, second)


@query("count_mismatch_join", sql(_MISMATCH, "tagged1", "tagged2", **_COUNT_TABLES))
def count_mismatch_join(spark, d):
    return _mismatches(spark, d)


_MISMATCHED_ENTRIES = sql(
    " UNION ALL ".join(
        f"""SELECT row_key AS rowkey, {n} AS side, qualifier, value FROM tagged{n}
        WHERE row_key IN (SELECT rowkey1 FROM mismatches)"""
        for n in (1, 2)
    ),
    "tagged1",
    "tagged2",
    **_COUNT_TABLES,
    mismatches=_MISMATCH,
)


def _unfold(documents):
    """Both maps of each document as rows."""
    sides = F.array(
        *[
            F.struct(F.lit(n).alias("side"), F.col(f"Table_Cluster{n}").alias("data"))
            for n in (1, 2)
        ]
    )
    rows = documents.select("rowkey", F.inline(sides))
    return rows.select("rowkey", "side", F.explode("data").alias("qualifier", "value"))


@query("detail_lookup_join", _MISMATCHED_ENTRIES)
def detail_lookup_join(spark, d):
    maps = [reads.read_dynamic_family(c, "e") for c in _tagged_pair(spark, d)]
    return _unfold(reconcile.detail_lookup_join(_mismatches(spark, d), *maps))


@query("diff_by_cell_count", _MISMATCHED_ENTRIES)
def diff_by_cell_count(spark, d):
    return _unfold(reconcile.diff_by_cell_count(*_tagged_pair(spark, d), "e"))


@query("write_diff_documents", _MISMATCHED_ENTRIES)
def diff_documents(spark, d):
    documents = reconcile.diff_by_cell_count(*_tagged_pair(spark, d), "e")
    index = scratch_path(spark, "index")
    write_diff_documents(documents, index)
    stored = read_diff_documents(
        spark,
        index,
        """rowkey bigint, part int, Table_Cluster1 map<string,double>,
        Table_Cluster2 map<string,double>, time_stamp timestamp""",
    )
    return _unfold(stored)
