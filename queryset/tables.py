"""Cell tables derived from the given tables, in Spark and, for the checks, in SQL.

``event_cells``    one numeric cell version per event; the event type is the qualifier
``tagged_cells``   the same with many more qualifiers (type and tag), as in a schema-free family
``order_cells``    per customer the status, price (cents) and priority of their orders, as text;
                   a medium priority counts as not given, so that some columns are missing

Two copies of a table are the same cells seen through two overlapping time ranges: some keys are
only in one of them, some values differ, some are equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrecon import ReadOptions, parse_catalog, read_table
from cellrecon.operators.reads import family_entries
from cellrecon.operators.writes import write_cells
from cellrecon.sources.cells import cells_from_rows, epoch_millis, within_time

Range = tuple[int, int]

# UTC midnights in epoch milliseconds.
Y1999, MID2000 = 915148800000, 962409600000
JAN01, JAN08, JAN15, JAN22, FEB01 = (
    1704067200000,
    1704672000000,
    1705276800000,
    1705881600000,
    1706745600000,
)

Y1995, Y1998, MID1999, Y2003 = 788918400000, 883612800000, 930787200000, 1041379200000
# Together these cover all orders and all events; most customers and users are on both sides.
ORDERS_1, ORDERS_2 = (Y1995, MID1999), (Y1998, Y2003)
EVENTS_1, EVENTS_2 = (JAN01, JAN22), (JAN08, FEB01)
ALL_EVENTS = (JAN01, FEB01)

ORDER_CATALOG = """{
    "table": {"namespace": "default", "name": "customer_orders"},
    "rowkey": "key",
    "columns": {
        "custkey": {"cf": "rowkey", "col": "key", "type": "bigint"},
        "status": {"cf": "o", "col": "status", "type": "string"},
        "price": {"cf": "o", "col": "price", "type": "bigint"},
        "priority": {"cf": "o", "col": "priority", "type": "string"}
    }
}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The tables' zone-less timestamps are UTC wall time.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, times: Range | None) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events if times is None else within_time(events, "ts", *times)


def event_cells(spark: SparkSession, sf_dir: str, times: Range | None = None) -> DataFrame:
    return cells_from_rows(
        _events(spark, sf_dir, times),
        row_key=F.col("user_id"),
        family="e",
        qualifier=F.col("event_type"),
        value=F.col("value"),
        stamp=epoch_millis(F.col("ts")),
        seq=F.col("event_id"),
    )


def tagged_cells(spark: SparkSession, sf_dir: str, times: Range | None = None) -> DataFrame:
    tag = F.get_json_object("props", "$.k")
    return cells_from_rows(
        _events(spark, sf_dir, times),
        row_key=F.col("user_id"),
        family="e",
        qualifier=F.concat("event_type", F.lit(":"), tag),
        value=F.col("value"),
        stamp=epoch_millis(F.col("ts")),
        seq=F.col("event_id"),
    )


def tagged_side(spark: SparkSession, sf_dir: str, times: Range) -> DataFrame:
    """Newest entries of the tagged family within a time range."""
    return family_entries(tagged_cells(spark, sf_dir, times), "e")


def order_rows(spark: SparkSession, sf_dir: str, times: Range | None = None) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if times is not None:
        orders = within_time(orders, "o_orderdate", *times)
    return orders.select(
        "o_custkey",
        "o_orderkey",
        epoch_millis(F.col("o_orderdate")).alias("ts"),
        F.col("o_orderstatus").alias("status"),
        F.floor(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("price"),
        F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priority"),
    )


def order_cells(spark: SparkSession, sf_dir: str, times: Range | None = None) -> DataFrame:
    return write_cells(
        order_rows(spark, sf_dir, times),
        "o_custkey",
        {c: ("o", c) for c in ("status", "price", "priority")},
        F.col("ts"),
        F.col("o_orderkey"),
    )


def customers(spark: SparkSession, sf_dir: str, times: Range | None = None) -> DataFrame:
    """Each customer's newest order values within a time range, typed: custkey, status, price, priority."""
    options = ReadOptions() if times is None else ReadOptions(min_ts=times[0], max_ts=times[1])
    cells = order_cells(spark, sf_dir, times)
    return read_table(cells, parse_catalog(ORDER_CATALOG), options)


def customer_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return customers(spark, sf_dir, ORDERS_1), customers(spark, sf_dir, ORDERS_2)


def order_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer the days each order was open; length and bounds follow from the order."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    lo = day.cast("bigint")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("grp"),
        lo.alias("lo"),
        (F.col("o_orderstatus") != "P").alias("lo_inc"),
        (lo + F.floor(F.col("o_totalprice") / 5000).cast("bigint")).alias("hi"),
        (F.col("o_orderpriority") < "3").alias("hi_inc"),
    )


def service_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer a fixed stretch of days some time after each order."""
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    lo = day.cast("bigint") + 30
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("grp"),
        lo.alias("lo"),
        (F.col("o_orderpriority") < "4").alias("lo_inc"),
        (lo + 45).alias("hi"),
        (F.col("o_orderstatus") == "F").alias("hi_inc"),
    )


def part_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of order keys, as many as there are parts."""
    lo = F.col("p_partkey") * 7
    return table(spark, sf_dir, "part").select(
        lo.alias("lo"),
        (F.col("p_size") > 20).alias("lo_inc"),
        (lo + F.floor(F.col("p_size") / 10).cast("bigint")).alias("hi"),
        (F.col("p_size") > 35).alias("hi_inc"),
    )


# ---- the same in SQL ----------------------------------------------------------------------------

_EVENTS = """SELECT user_id AS row_key, 'e' AS family, {qualifier} AS qualifier,
    epoch_us(ts) // 1000 AS ts, event_id AS seq, value FROM events"""

_ORDER_CELL = """SELECT o_custkey AS row_key, 'o' AS family, '{name}' AS qualifier,
    epoch_us(o_orderdate) // 1000 AS ts, o_orderkey AS seq, {value} AS value FROM orders"""

_LATEST_ORDERS = """SELECT row_key AS custkey,
    arg_max(value, (ts, seq)) FILTER (WHERE qualifier = 'status') AS status,
    CAST(arg_max(value, (ts, seq)) FILTER (WHERE qualifier = 'price') AS BIGINT) AS price,
    arg_max(value, (ts, seq)) FILTER (WHERE qualifier = 'priority') AS priority
    FROM order_cells {where} GROUP BY row_key"""


def _between(times: Range) -> str:
    return f"WHERE ts >= {times[0]} AND ts < {times[1]}"


_LATEST_TAGGED = """SELECT row_key, qualifier, arg_max(value, (ts, seq)) AS value
    FROM tagged_cells {where} GROUP BY row_key, qualifier"""

_CTES = {
    "event_cells": _EVENTS.format(qualifier="event_type"),
    "tagged_cells": _EVENTS.format(
        qualifier="event_type || ':' || json_extract_string(props, '$.k')"
    ),
    "tagged1": _LATEST_TAGGED.format(where=_between(EVENTS_1)),
    "tagged2": _LATEST_TAGGED.format(where=_between(EVENTS_2)),
    "order_cells": " UNION ALL ".join(
        [
            _ORDER_CELL.format(name="status", value="o_orderstatus"),
            _ORDER_CELL.format(
                name="price", value="CAST(CAST(floor(o_totalprice * 100) AS BIGINT) AS VARCHAR)"
            ),
            _ORDER_CELL.format(name="priority", value="o_orderpriority")
            + " WHERE o_orderpriority <> '3-MEDIUM'",
        ]
    ),
    "customers": _LATEST_ORDERS.format(where=""),
    "customers1": _LATEST_ORDERS.format(where=_between(ORDERS_1)),
    "customers2": _LATEST_ORDERS.format(where=_between(ORDERS_2)),
    "order_ranges": """SELECT o_custkey AS grp,
        CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS lo,
        o_orderstatus <> 'P' AS lo_inc,
        CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))
            + floor(o_totalprice / 5000) AS BIGINT) AS hi,
        o_orderpriority < '3' AS hi_inc FROM orders""",
    "service_ranges": """SELECT o_custkey AS grp,
        CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 30 AS BIGINT) AS lo,
        o_orderpriority < '4' AS lo_inc,
        CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 75 AS BIGINT) AS hi,
        o_orderstatus = 'F' AS hi_inc FROM orders""",
    "part_ranges": """SELECT p_partkey * 7 AS lo, p_size > 20 AS lo_inc,
        p_partkey * 7 + CAST(floor(p_size / 10) AS BIGINT) AS hi, p_size > 35 AS hi_inc FROM part""",
}

_NEEDS = {
    "tagged1": ["tagged_cells"],
    "tagged2": ["tagged_cells"],
    "customers": ["order_cells"],
    "customers1": ["order_cells"],
    "customers2": ["order_cells"],
}


def sql(body: str, *tables: str, **more: str) -> str:
    """``body`` with the derived tables it names, and further named subqueries."""
    names: list[str] = []
    for t in tables:
        for name in [*_NEEDS.get(t, []), t]:
            if name not in names:
                names.append(name)
    parts = [f"{n} AS ({_CTES[n]})" for n in names] + [f"{n} AS ({q})" for n, q in more.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
