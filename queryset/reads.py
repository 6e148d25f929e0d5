"""Queries: scans, typed reads, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellrecon.operators import reads, reconcile, scans
from cellrecon.sources.cells import read_pair
from queryset.registry import query
from queryset.tables import (
    ALL_EVENTS,
    JAN08,
    JAN15,
    Y1999,
    customers,
    event_cells,
    order_cells,
    sql,
    table,
    tagged_cells,
)

EVENT_TYPES = ["error", "click", "view", "signup", "purchase"]

VERSIONS = """SELECT row_key, family, qualifier, ts, arg_max(value, seq) AS value
    FROM {cells} GROUP BY row_key, family, qualifier, ts"""
RANKED = """SELECT *, row_number() OVER (
    PARTITION BY row_key, family, qualifier ORDER BY ts DESC) AS rank FROM versions"""


@query("scan_cells", sql("SELECT row_key, qualifier, value FROM event_cells WHERE value > 10", "event_cells"))
def scan_cells(spark, d):
    return scans.scan_cells(
        event_cells(spark, d), ["row_key", "qualifier", "value"], F.col("value") > 10
    )


@query("read_catalog_typed", sql("SELECT custkey, status, price, priority FROM customers", "customers"))
def read_catalog_typed(spark, d):
    return customers(spark, d)


@query(
    "read_latest_wide",
    sql(
        "SELECT row_key, "
        + ", ".join(
            f"arg_max(value, (ts, seq)) FILTER (WHERE qualifier = '{t}') AS {t}" for t in EVENT_TYPES
        )
        + f" FROM event_cells WHERE ts >= {JAN08} AND ts < {JAN15} GROUP BY row_key",
        "event_cells",
    ),
)
def read_latest_wide(spark, d):
    week = scans.scan_time_range(event_cells(spark, d, (JAN08, JAN15)), JAN08, JAN15)
    return reads.read_latest_wide(week, {t: ("e", t) for t in EVENT_TYPES})


@query(
    "read_version_rows",
    sql(
        """SELECT DISTINCT row_key, status, priority FROM (
        SELECT row_key, ts, arg_max(value, seq) FILTER (WHERE qualifier = 'status') AS status,
            arg_max(value, seq) FILTER (WHERE qualifier = 'priority') AS priority
        FROM order_cells WHERE qualifier IN ('status', 'priority') GROUP BY row_key, ts)""",
        "order_cells",
    ),
)
def read_version_rows(spark, d):
    return reads.read_version_rows(
        order_cells(spark, d), {"status": ("o", "status"), "priority": ("o", "priority")}
    )


@query(
    "read_version_map",
    sql(
        """SELECT row_key, ts, value FROM ranked
        WHERE qualifier = 'price'""",
        "order_cells",
        versions=VERSIONS.format(cells="order_cells"),
        ranked=RANKED,
    ),
)
def read_version_map(spark, d):
    maps = reads.read_version_map(order_cells(spark, d), "o", "price")
    return maps.select("row_key", F.explode("data").alias("ts", "value"))


@query(
    "read_dynamic_family",
    sql(
        """SELECT row_key, qualifier, arg_max(value, (ts, seq)) AS value FROM tagged_cells
        WHERE qualifier NOT IN ('click:1', 'view:2') GROUP BY row_key, qualifier""",
        "tagged_cells",
    ),
)
def read_dynamic_family(spark, d):
    maps = reads.read_dynamic_family(tagged_cells(spark, d), "e", declared=["click:1", "view:2"])
    return maps.select("row_key", F.explode("data").alias("qualifier", "value"))


@query(
    "read_dynamic_versions",
    sql(
        "SELECT row_key, qualifier, ts, value FROM ranked",
        "event_cells",
        versions=VERSIONS.format(cells="event_cells"),
        ranked=RANKED,
    ),
)
def read_dynamic_versions(spark, d):
    maps = reads.read_dynamic_versions(event_cells(spark, d), "e")
    outer = maps.select("row_key", F.explode("data").alias("qualifier", "versions"))
    return outer.select("row_key", "qualifier", F.explode("versions").alias("ts", "value"))


@query(
    "read_qualifier_regex",
    sql(
        """SELECT row_key, name, arg_max(value, qualifier) AS value FROM (
            SELECT row_key, qualifier, regexp_extract(qualifier, '^(?:click:(.).*)$', 1) AS name,
                arg_max(value, (ts, seq)) AS value
            FROM tagged_cells WHERE regexp_full_match(qualifier, 'click:(.).*')
            GROUP BY row_key, qualifier)
        GROUP BY row_key, name""",
        "tagged_cells",
    ),
)
def read_qualifier_regex(spark, d):
    maps = reads.read_qualifier_regex(tagged_cells(spark, d), "e", "click:(.).*")
    return maps.select("row_key", F.explode("data").alias("name", "value"))


@query(
    "scan_time_range",
    sql(f"SELECT * FROM event_cells WHERE ts >= {JAN08} AND ts < {JAN15}", "event_cells"),
)
def scan_time_range(spark, d):
    return scans.scan_time_range(event_cells(spark, d, (JAN08, JAN15)), JAN08, JAN15)


@query("scan_at_timestamp", sql(f"SELECT * FROM order_cells WHERE ts = {Y1999}", "order_cells"))
def scan_at_timestamp(spark, d):
    return scans.scan_at_timestamp(order_cells(spark, d, (Y1999, Y1999 + 1)), Y1999)


@query(
    "scan_max_versions",
    sql(
        "SELECT row_key, family, qualifier, ts, value FROM ranked WHERE rank <= 3",
        "event_cells",
        versions=VERSIONS.format(cells="event_cells"),
        ranked=RANKED,
    ),
)
def scan_max_versions(spark, d):
    return scans.newest_versions(event_cells(spark, d), 3)


@query(
    "project_columns",
    sql("SELECT * FROM event_cells WHERE qualifier IN ('click', 'view')", "event_cells"),
)
def project_columns(spark, d):
    return scans.project_columns(event_cells(spark, d), [("e", "click"), ("e", "view")])


BOTH_FAMILIES = """SELECT row_key, family, qualifier, ts, seq, CAST(value AS VARCHAR) AS value
    FROM order_cells UNION ALL SELECT row_key, family, qualifier, ts, seq,
    CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS value FROM event_cells"""


@query(
    "project_family",
    sql("SELECT * FROM cells WHERE family = 'e'", "order_cells", "event_cells", cells=BOTH_FAMILIES),
)
def project_family(spark, d):
    cents = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    cells = order_cells(spark, d).unionByName(event_cells(spark, d).withColumn("value", cents))
    return scans.project_families(cells, ["e"])


@query(
    "multi_get",
    sql(
        """SELECT * FROM order_cells WHERE row_key IN
        (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
        "order_cells",
    ),
)
def multi_get(spark, d):
    customer = table(spark, d, "customer")
    keys = customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return scans.multi_get(order_cells(spark, d), keys)


@query(
    "read_pair",
    sql(
        f"""SELECT row_key, qualifier, arg_max(value, (ts, seq)) AS value, 1 AS side FROM event_cells
        WHERE ts >= {ALL_EVENTS[0]} AND ts < {ALL_EVENTS[1]} GROUP BY row_key, qualifier
        UNION ALL
        SELECT row_key, qualifier, arg_max(value, (ts, seq)) AS value, 2 AS side FROM tagged_cells
        WHERE ts >= {ALL_EVENTS[0]} AND ts < {ALL_EVENTS[1]} GROUP BY row_key, qualifier""",
        "event_cells",
        "tagged_cells",
    ),
)
def pair(spark, d):
    return read_pair(
        event_cells(spark, d, ALL_EVENTS),
        tagged_cells(spark, d, ALL_EVENTS),
        lambda cells: reads.family_entries(scans.scan_time_range(cells, *ALL_EVENTS), "e"),
    )


@query("select_columns", sql("SELECT custkey, price FROM customers", "customers"))
def select_columns(spark, d):
    return reconcile.select_columns(customers(spark, d), ["custkey"], ["price", "custkey"])


@query(
    "cells_per_row",
    sql(
        "SELECT row_key, count(DISTINCT (family, qualifier)) AS count FROM tagged_cells GROUP BY row_key",
        "tagged_cells",
    ),
)
def cells_per_row(spark, d):
    return reads.cells_per_row(tagged_cells(spark, d))


@query(
    "preview_rows",
    sql("SELECT custkey, status, price, priority FROM customers ORDER BY custkey LIMIT 10", "customers"),
)
def preview_rows(spark, d):
    return reconcile.preview_rows(customers(spark, d), "custkey", 10)
