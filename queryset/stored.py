"""Queries over encoded and stored cell tables: key conditions, late decoding, files chosen by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrecon import ReadOptions, parse_catalog, read_table, write_table
from cellrecon.operators import key_conditions, reads, reconcile, scans, writes
from cellrecon.operators.ranges import partition_of
from cellrecon.session import scratch_path
from cellrecon.sources import stored
from cellrecon.sources.cells import epoch_millis
from queryset.registry import query
from queryset.tables import (
    EVENTS_1,
    EVENTS_2,
    JAN15,
    ORDERS_1,
    ORDERS_2,
    event_cells,
    order_cells,
    part_ranges,
    sql,
    table,
    tagged_cells,
)

# ---- conditions on encoded keys -----------------------------------------------------------------

PRICED_CATALOG = """{
    "table": {"namespace": "default", "name": "orders", "version": "2.0", "tableCoder": "Phoenix"},
    "rowkey": "total:order",
    "columns": {
        "o_totalprice": {"cf": "rowkey", "col": "total", "type": "double"},
        "o_orderkey": {"cf": "rowkey", "col": "order", "type": "bigint"},
        "o_orderstatus": {"cf": "s", "col": "status", "type": "string"},
        "o_custkey": {"cf": "s", "col": "customer", "type": "bigint"}
    }
}"""

URGENCY_CATALOG = """{
    "table": {"namespace": "default", "name": "orders", "version": "2.0", "tableCoder": "Phoenix"},
    "rowkey": "priority:customer:order",
    "columns": {
        "o_orderpriority": {"cf": "rowkey", "col": "priority", "type": "string"},
        "o_custkey": {"cf": "rowkey", "col": "customer", "type": "bigint"},
        "o_orderkey": {"cf": "rowkey", "col": "order", "type": "bigint"},
        "o_totalprice": {"cf": "p", "col": "total", "type": "double"}
    }
}"""


def _stored_orders(spark, d, catalog) -> DataFrame:
    """All orders as an encoded cell table in files sorted by key."""
    rows = table(spark, d, "orders").select(*[c.name for c in catalog.columns])
    path = scratch_path(spark, "encoded-orders")
    writes.write_sorted(write_table(rows, catalog, ts=JAN15), path, 8)
    return spark.read.parquet(path)


@query(
    "read_key_range_encoded",
    """SELECT o_totalprice, o_orderkey, o_orderstatus, o_custkey FROM orders
    WHERE o_totalprice > 100000.5 AND o_totalprice <= 150000.25""",
)
def read_key_range_encoded(spark, d):
    catalog = parse_catalog(PRICED_CATALOG)
    prices = key_conditions.key_between(
        "o_totalprice", 100000.5, 150000.25, low_inclusive=False, high_inclusive=True
    )
    return read_table(_stored_orders(spark, d, catalog), catalog, key_conditions=[prices])


@query(
    "read_key_skip_scan",
    """SELECT o_orderpriority, o_custkey, o_orderkey, o_totalprice FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') AND o_custkey >= 20 AND o_custkey < 60""",
)
def read_key_skip_scan(spark, d):
    catalog = parse_catalog(URGENCY_CATALOG)
    conditions = [
        key_conditions.key_in("o_orderpriority", ["1-URGENT", "4-NOT SPECIFIED"]),
        key_conditions.key_between("o_custkey", 20, 60),
    ]
    return read_table(_stored_orders(spark, d, catalog), catalog, key_conditions=conditions)


# ---- encoded tables compared late ---------------------------------------------------------------

CUSTOMER_CATALOG = """{
    "table": {"namespace": "default", "name": "customer_orders", "version": "2.0", "tableCoder": "Phoenix"},
    "rowkey": "key",
    "columns": {
        "custkey": {"cf": "rowkey", "col": "key", "type": "bigint"},
        "status": {"cf": "o", "col": "status", "type": "string"},
        "total": {"cf": "p", "col": "total", "type": "double"},
        "priority": {"cf": "o", "col": "priority", "type": "string"}
    }
}"""


def _encoded_sides(spark, d):
    """Every order's values as encoded cells, of which two copies see two overlapping time ranges."""
    catalog = parse_catalog(CUSTOMER_CATALOG)
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priority"),
        epoch_millis(F.col("o_orderdate")).alias("ts"),
        F.col("o_orderkey").alias("seq"),
    )
    cells = write_table(rows, catalog, ts=F.col("ts"), seq=F.col("seq"))
    return catalog, [scans.scan_time_range(cells, *times) for times in (ORDERS_1, ORDERS_2)]


_ENCODED_SIDE = """SELECT o_custkey AS custkey, arg_max(o_orderstatus, (ts, o_orderkey)) AS status,
    arg_max(o_totalprice, (ts, o_orderkey)) AS total,
    arg_max(o_orderpriority, (ts, o_orderkey)) FILTER (WHERE o_orderpriority <> '3-MEDIUM') AS priority
    FROM (SELECT *, epoch_us(o_orderdate) // 1000 AS ts FROM orders) WHERE ts >= {a} AND ts < {b} GROUP BY o_custkey"""
_ENCODED_SIDES = {
    "side1": _ENCODED_SIDE.format(a=ORDERS_1[0], b=ORDERS_1[1]),
    "side2": _ENCODED_SIDE.format(a=ORDERS_2[0], b=ORDERS_2[1]),
}
_NAMES = ["status", "total", "priority"]
_PICKED = ", ".join(
    f"CASE WHEN a.custkey IS NOT NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in ["custkey", *_NAMES]
)
_TEXT = " || ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c} ' ELSE '' END" for c in _NAMES)


@query(
    "diff_encoded_tables",
    sql(
        f"""SELECT * FROM (SELECT {_PICKED},
            CASE WHEN a.custkey IS NULL THEN 'New row in DataFrame 2'
                 WHEN b.custkey IS NULL THEN 'New row in DataFrame 1' ELSE {_TEXT} END AS Diff
        FROM side1 a FULL JOIN side2 b ON a.custkey = b.custkey) WHERE Diff <> ''""",
        **_ENCODED_SIDES,
    ),
)
def diff_encoded_tables(spark, d):
    catalog, sides = _encoded_sides(spark, d)
    return reconcile.diff_encoded_tables(*sides, catalog, join=True)


@query(
    "diff_encoded_columns",
    sql(
        " UNION ALL ".join(
            f"""SELECT a.custkey AS custkey, '{c}' AS "column", CAST(a.{c} AS VARCHAR) AS value1,
            CAST(b.{c} AS VARCHAR) AS value2 FROM side1 a JOIN side2 b
            ON a.custkey = b.custkey WHERE a.{c} IS DISTINCT FROM b.{c}"""
            for c in ("status", "priority")
        ),
        **_ENCODED_SIDES,
    ),
)
def diff_encoded_columns(spark, d):
    catalog, sides = _encoded_sides(spark, d)
    # Numbers are written as text in different ways by different engines.
    return reconcile.diff_encoded_columns(*sides, catalog).filter(F.col("column") != "total")


_CHANGED = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _NAMES)


@query(
    "diff_encoded_summary",
    sql(
        f"""SELECT count(a.custkey) AS rows1, count(b.custkey) AS rows2,
            count(*) FILTER (WHERE b.custkey IS NULL) AS only_in_1,
            count(*) FILTER (WHERE a.custkey IS NULL) AS only_in_2,
            count(*) FILTER (WHERE a.custkey IS NOT NULL AND b.custkey IS NOT NULL AND ({_CHANGED})) AS changed,
            count(*) FILTER (WHERE a.custkey IS NOT NULL AND b.custkey IS NOT NULL AND NOT ({_CHANGED})) AS same
        FROM side1 a FULL JOIN side2 b ON a.custkey = b.custkey""",
        **_ENCODED_SIDES,
    ),
)
def diff_encoded_summary(spark, d):
    catalog, sides = _encoded_sides(spark, d)
    return reconcile.diff_encoded_summary(*sides, catalog)


@query(
    "diff_family",
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
def diff_family(spark, d):
    return reconcile.diff_family(tagged_cells(spark, d, EVENTS_1), tagged_cells(spark, d, EVENTS_2), "e")


# ---- tables of all shapes, many versions --------------------------------------------------------

SHAPES_CATALOG = """{
    "table": {"namespace": "default", "name": "activity"},
    "rowkey": "key",
    "columns": {
        "user": {"cf": "rowkey", "col": "key", "type": "bigint"},
        "signup": {"cf": "e", "col": "signup", "type": "double"},
        "others": {"cf": "e", "col": "", "type": "map<string,double>"},
        "clicks": {"cf": "e", "col": "click", "type": "map<bigint,double>"},
        "history": {"cf": "w", "col": "", "type": "map<string,map<bigint,double>>"}
    }
}"""

_LATEST = """SELECT row_key, qualifier, arg_max(value, (ts, seq)) AS value FROM event_cells GROUP BY row_key, qualifier"""
_VERSIONS = """SELECT row_key, qualifier, ts, arg_max(value, seq) AS value FROM event_cells GROUP BY row_key, qualifier, ts"""


@query(
    "read_table_shapes",
    sql(
        """SELECT row_key AS "user", 'others' AS slot, qualifier, CAST(NULL AS BIGINT) AS ts, value, signup
            FROM latest LEFT JOIN signups USING (row_key) WHERE qualifier NOT IN ('signup', 'click')
        UNION ALL SELECT row_key, 'clicks', '', ts, value, signup FROM versions LEFT JOIN signups USING (row_key)
            WHERE qualifier = 'click'
        UNION ALL SELECT row_key, 'history', qualifier, ts, value, signup FROM versions LEFT JOIN signups USING (row_key)""",
        "event_cells",
        latest=_LATEST,
        versions=_VERSIONS,
        signups="SELECT row_key, value AS signup FROM latest WHERE qualifier = 'signup'",
    ),
)
def read_table_shapes(spark, d):
    """A scalar, a family's newest values, one column's versions and a family's versions, from one scan."""
    events = event_cells(spark, d)
    cells = events.withColumn("family", F.explode(F.array(F.lit("e"), F.lit("w"))))
    rows = read_table(cells, parse_catalog(SHAPES_CATALOG), ReadOptions(max_versions=None), parts=3)
    none = F.lit(None).cast("bigint")
    slots = F.array(
        F.struct(F.lit("others").alias("slot"), F.transform(F.map_entries("others"), lambda e: F.struct(
            e["key"].alias("qualifier"), none.alias("ts"), e["value"].alias("value"))).alias("entries")),
        F.struct(F.lit("clicks").alias("slot"), F.transform(F.map_entries("clicks"), lambda e: F.struct(
            F.lit("").alias("qualifier"), e["key"].alias("ts"), e["value"].alias("value"))).alias("entries")),
        F.struct(F.lit("history").alias("slot"), F.flatten(F.transform(F.map_entries("history"), lambda q: F.transform(
            F.map_entries(q["value"]), lambda e: F.struct(
                q["key"].alias("qualifier"), e["key"].alias("ts"), e["value"].alias("value"))))).alias("entries")),
    )
    return rows.select("user", "signup", F.inline(slots)).select("user", "signup", "slot", F.inline("entries"))


@query(
    "scan_many_versions",
    """SELECT event_type AS row_key, 'e' AS family, 'all' AS qualifier, ts, value FROM (
        SELECT event_type, epoch_us(ts) // 1000 AS ts, max(value) AS value,
            row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts) // 1000 DESC) AS n
        FROM events GROUP BY event_type, epoch_us(ts) // 1000) WHERE n <= 1500""",
)
def scan_many_versions(spark, d):
    """The newest 1,500 versions of a few cells that hold all the table."""
    cells = event_cells(spark, d).drop("seq").select(
        F.col("qualifier").alias("row_key"), "family", F.lit("all").alias("qualifier"), "ts", "value"
    )
    return scans.newest_versions(cells, 1500)


@query(
    "read_qualifier_scalar",
    sql(
        """SELECT row_key, max(qualifier) AS qualifier, arg_max(value, (qualifier, ts, seq)) AS value
        FROM tagged_cells WHERE regexp_full_match(qualifier, 'click:[0-9]+') GROUP BY row_key""",
        "tagged_cells",
    ),
)
def read_qualifier_scalar(spark, d):
    return reads.read_qualifier_scalar(tagged_cells(spark, d), "e", "click:[0-9]+")


# ---- files chosen by key ------------------------------------------------------------------------

NAME_BOUNDS = list("cfilprtz")


@query(
    "presplit_files",
    f"""SELECT key_range, count(*) AS rows, min(p_name) AS least, max(p_name) AS greatest, CAST(0 AS BIGINT) AS astray
    FROM (SELECT p_name, CAST({' + '.join(f"(p_name >= '{b}')::INT" for b in NAME_BOUNDS)} AS BIGINT) AS key_range FROM part)
    GROUP BY key_range""",
)
def presplit_files(spark, d):
    """Parts stored along declared bounds of their names: what the files of each range hold, none of it astray."""
    part = table(spark, d, "part")
    cells = part.select(
        F.col("p_name").alias("row_key"), F.lit("p").alias("family"), F.lit("size").alias("qualifier"),
        F.lit(JAN15).cast("bigint").alias("ts"), F.col("p_size").alias("value"),
    )
    path = scratch_path(spark, "presplit")
    writes.write_presplit(cells, path, len(NAME_BOUNDS) + 1, NAME_BOUNDS, files=24)
    stored.write_manifest(spark, path)
    files = stored.read_manifest(spark, path).withColumns(
        {"key_range": partition_of(F.col("least"), NAME_BOUNDS), "last": partition_of(F.col("greatest"), NAME_BOUNDS)}
    )
    return files.groupBy(F.col("key_range").cast("bigint").alias("key_range")).agg(
        F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.count_if(F.col("key_range") != F.col("last")).alias("astray"),
    )


def _sorted_orders(spark, d) -> str:
    path = scratch_path(spark, "sorted-orders")
    cells = order_cells(spark, d)
    keyed = cells.select(F.col("seq").alias("row_key"), "family", "qualifier", "ts", "value")
    writes.write_sorted(keyed, path, 16)
    stored.write_manifest(spark, path)
    return path


_BY_ORDER = "SELECT seq AS row_key, family, qualifier, ts, value FROM order_cells"


@query(
    "filter_by_ranges_stored",
    sql(
        f"""SELECT * FROM ({_BY_ORDER}) c WHERE EXISTS (SELECT 1 FROM part_ranges r
        WHERE (c.row_key > r.lo OR (r.lo_inc AND c.row_key = r.lo)) AND (c.row_key < r.hi OR (r.hi_inc AND c.row_key = r.hi)))""",
        "order_cells",
        "part_ranges",
    ),
)
def filter_by_ranges_stored(spark, d):
    return stored.read_ranges(spark, _sorted_orders(spark, d), part_ranges(spark, d))


@query(
    "multi_get_stored",
    sql(
        f"SELECT * FROM ({_BY_ORDER}) c WHERE c.row_key IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_discount = 0.1)",
        "order_cells",
    ),
)
def multi_get_stored(spark, d):
    lines = table(spark, d, "lineitem").filter("l_quantity = 50 AND l_discount = 0.1")
    return stored.multi_get_stored(spark, _sorted_orders(spark, d), lines.select("l_orderkey"))
