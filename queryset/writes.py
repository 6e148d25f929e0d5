"""Queries: encodings and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon import parse_catalog, read_table, write_table
from cellrecon.functions import codecs, record_bytes, records
from cellrecon.functions.codecs import Codec, KeyPart
from cellrecon.operators import reads, writes
from cellrecon.session import scratch_path
from cellrecon.sources.cells import read_cells
from queryset.registry import query
from queryset.tables import (
    JAN15,
    MID2000,
    ORDERS_1,
    ORDERS_2,
    customers,
    event_cells,
    order_cells,
    sql,
    table,
    tagged_cells,
)

# ---- encodings ----------------------------------------------------------------------------------

TYPES = {
    "n64": T.LongType(),
    "n32": T.IntegerType(),
    "n16": T.ShortType(),
    "n8": T.ByteType(),
    "f64": T.DoubleType(),
    "f32": T.FloatType(),
    "text": T.StringType(),
    "flag": T.BooleanType(),
}

_SQL_VALUES = """SELECT l_orderkey, l_linenumber, (l_partkey - l_orderkey) * 1000003 AS n64,
    CAST(l_partkey - l_orderkey AS INTEGER) AS n32,
    CAST((l_partkey - l_orderkey) % 30000 AS SMALLINT) AS n16,
    CAST((l_partkey - l_orderkey) % 128 AS TINYINT) AS n8,
    l_extendedprice * (1 - l_quantity / 20) AS f64,
    CAST(l_tax - l_discount AS FLOAT) AS f32, l_returnflag || l_linestatus AS text,
    l_returnflag = 'R' AS flag FROM lineitem"""


def _typed(spark, d) -> DataFrame:
    """Line items as one column of every scalar type, negative numbers included."""
    gap = F.col("l_partkey") - F.col("l_orderkey")
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (gap * 1000003).alias("n64"),
        gap.cast("int").alias("n32"),
        (gap % 30000).cast("short").alias("n16"),
        (gap % 128).cast("byte").alias("n8"),
        (F.col("l_extendedprice") * (1 - F.col("l_quantity") / 20)).alias("f64"),
        (F.col("l_tax") - F.col("l_discount")).cast("float").alias("f32"),
        F.concat("l_returnflag", "l_linestatus").alias("text"),
        (F.col("l_returnflag") == "R").alias("flag"),
    )


def _encoded(spark, d, encode) -> DataFrame:
    cells = {name: encode(F.col(name), dt) for name, dt in TYPES.items()}
    return _typed(spark, d).withColumns(cells)


def _hex_of(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.hex(name) for name in TYPES})


def _decoded(rows: DataFrame, decode) -> DataFrame:
    return rows.withColumns({name: decode(F.col(name), dt) for name, dt in TYPES.items()})


_UNSIGNED = {8: "UBIGINT", 4: "UINTEGER", 2: "USMALLINT", 1: "UTINYINT"}


def _bits(column: str, width: int) -> str:
    return f"CAST(CAST({column} AS BIT) AS {_UNSIGNED[width]})"


def _hex_sql(columns: dict[str, str]) -> str:
    parts = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"WITH typed AS ({_SQL_VALUES}) SELECT l_orderkey, l_linenumber, {parts} FROM typed"


_INTEGERS = {"n64": 8, "n32": 4, "n16": 2, "n8": 1}
_FLOATS = {"f64": 8, "f32": 4}
_NATIVE = {
    n: f"format('{{:0{2 * w}X}}', {_bits(n, w)})" for n, w in {**_INTEGERS, **_FLOATS}.items()
} | {"text": "hex(text)", "flag": "CASE WHEN flag THEN 'FF' ELSE '00' END"}
_SORTABLE = (
    {
        n: f"format('{{:0{2 * w}X}}', xor({_bits(n, w)}, {2 ** (8 * w - 1)}))"
        for n, w in _INTEGERS.items()
    }
    | {
        n: f"""format('{{:0{2 * w}X}}', CASE WHEN {_bits(n, w)} >= {2 ** (8 * w - 1)}
        THEN {2 ** (8 * w) - 1} - {_bits(n, w)} ELSE {_bits(n, w)} + {2 ** (8 * w - 1)} END)"""
        for n, w in _FLOATS.items()
    }
    | {"text": "hex(text)", "flag": "CASE WHEN flag THEN '01' ELSE '00' END"}
)


@query("encode_native", _hex_sql(_NATIVE))
def encode_native(spark, d):
    return _hex_of(_encoded(spark, d, codecs.encode_native))


@query("decode_native", _SQL_VALUES)
def decode_native(spark, d):
    return _decoded(_encoded(spark, d, codecs.encode_native), codecs.decode_native)


@query("encode_sortable", _hex_sql(_SORTABLE))
def encode_sortable(spark, d):
    return _hex_of(_encoded(spark, d, codecs.encode_sortable))


@query("decode_sortable", _SQL_VALUES)
def decode_sortable(spark, d):
    return _decoded(_encoded(spark, d, codecs.encode_sortable), codecs.decode_sortable)


LINE_KEY = [KeyPart(T.LongType()), KeyPart(T.IntegerType())]
ORDER_KEY = [KeyPart(T.StringType()), KeyPart(T.LongType()), KeyPart(T.StringType())]


@query(
    "encode_composite_key",
    """SELECT l_orderkey, l_linenumber,
        format('{:016X}', CAST(l_orderkey AS UBIGINT))
            || format('{:08X}', CAST(l_linenumber AS UINTEGER)) AS native,
        format('{:016X}', CAST(l_orderkey AS UBIGINT) + 9223372036854775808)
            || format('{:08X}', CAST(l_linenumber AS BIGINT) + 2147483648) AS sortable
    FROM lineitem""",
)
def encode_composite_key(spark, d):
    columns = [F.col("l_orderkey"), F.col("l_linenumber")]
    return table(spark, d, "lineitem").select(
        *columns,
        *[
            F.hex(codecs.encode_composite_key(columns, LINE_KEY, coder)).alias(coder)
            for coder in (codecs.NATIVE, codecs.SORTABLE)
        ],
    )


@query(
    "decode_composite_key",
    "SELECT o_orderpriority, o_orderkey - o_custkey AS gap, o_orderstatus FROM orders",
)
def decode_composite_key(spark, d):
    gap = F.col("o_orderkey") - F.col("o_custkey")
    columns = [F.col("o_orderpriority"), gap, F.col("o_orderstatus")]
    keys = table(spark, d, "orders").select(
        codecs.encode_composite_key(columns, ORDER_KEY).alias("key")
    )
    parts = codecs.decode_composite_key(F.col("key"), ORDER_KEY)
    names = ("o_orderpriority", "gap", "o_orderstatus")
    return keys.select(*[p.alias(n) for p, n in zip(parts, names, strict=True)])


EVENT_RECORD = T.StructType(
    [
        T.StructField("k", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("at", T.TimestampType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("sums", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def _records(spark, d) -> DataFrame:
    record = F.struct(
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("event_type").alias("type"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("at"),
        F.array("event_type", F.lit("x")).alias("tags"),
        F.create_map(F.lit("value"), F.col("value")).alias("sums"),
    )
    return table(spark, d, "events").select("event_id", record.alias("record"))


@query(
    "encode_struct",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS type,
        CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS amount,
        CAST(epoch_us(ts) // 1000 AS VARCHAR) AS at FROM events""",
)
def encode_struct(spark, d):
    cell = records.encode_record(F.col("record"), EVENT_RECORD).cast("string")
    fields = ("k", "type", "amount", "at")
    cells = _records(spark, d).select("event_id", cell.alias("cell"))
    return cells.select(
        "event_id", *[F.get_json_object("cell", f"$.v.{f}").alias(f) for f in fields]
    )


@query(
    "decode_struct",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type AS type,
        CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents,
        epoch_us(ts) // 1000 AS at, event_type || ',x' AS tags, value FROM events""",
)
def decode_struct(spark, d):
    cells = _records(spark, d).select(
        "event_id", records.encode_record(F.col("record"), EVENT_RECORD).alias("cell")
    )
    r = F.col("r")
    return cells.select(
        "event_id", records.decode_record(F.col("cell"), EVENT_RECORD).alias("r")
    ).select(
        "event_id",
        r["k"].alias("k"),
        r["type"].alias("type"),
        (r["amount"] * 100).cast("bigint").alias("cents"),
        F.unix_millis(r["at"]).alias("at"),
        F.concat_ws(",", r["tags"]).alias("tags"),
        r["sums"]["value"].alias("value"),
    )


READING_SCHEMA = """{
    "type": "record", "name": "Reading", "fields": [
        {"name": "k", "type": "int"},
        {"name": "type", "type": "string"},
        {"name": "value", "type": ["null", "double"]},
        {"name": "tags", "type": {"type": "array", "items": "string"}}
    ]
}"""


def _readings(spark, d) -> DataFrame:
    record = F.struct(
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("event_type").alias("type"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.when(F.col("event_type") == "click", F.array(F.lit("a"), F.lit("bc"))).otherwise(F.array().cast("array<string>")).alias("tags"),
    )
    dt = records.record_data_type(READING_SCHEMA)
    cell = record_bytes.encode_record_bytes(F.col("record"), dt, READING_SCHEMA)
    return table(spark, d, "events").select("event_id", record.alias("record")).select("event_id", cell.alias("cell"))


_BIG = "format('{:016X}', CAST(CAST(value AS BIT) AS UBIGINT))"
_LITTLE = " || ".join(f"substr({_BIG}, {k}, 2)" for k in range(15, 0, -2))


@query(
    "encode_record_bytes",
    f"""SELECT event_id, CASE WHEN 2 * k < 128 THEN format('{{:02X}}', 2 * k)
            ELSE format('{{:02X}}{{:02X}}', 2 * k % 128 + 128, 2 * k // 128) END
        || format('{{:02X}}', 2 * length(event_type)) || hex(event_type)
        || CASE WHEN event_type = 'view' THEN '00' ELSE '02' || {_LITTLE} END
        || CASE WHEN event_type = 'click' THEN '04026104626300' ELSE '00' END AS cell
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
)
def encode_record_cells(spark, d):
    return _readings(spark, d).select("event_id", F.hex("cell").alias("cell"))


@query(
    "decode_record_bytes",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type AS type,
        CASE WHEN event_type <> 'view' THEN value END AS value,
        CASE WHEN event_type = 'click' THEN 'a,bc' ELSE '' END AS tags FROM events""",
)
def decode_record_cells(spark, d):
    dt = records.record_data_type(READING_SCHEMA)
    back = record_bytes.decode_record_bytes(F.col("cell"), dt, READING_SCHEMA)
    rows = _readings(spark, d).select("event_id", back.alias("r"))
    return rows.select("event_id", "r.k", "r.type", "r.value", F.concat_ws(",", "r.tags").alias("tags"))


MIRROR = Codec(
    encode=lambda value, dt: F.reverse(value.cast("string")).cast("binary"),
    decode=lambda cell, dt: F.reverse(cell.cast("string")).cast(dt),
    keys=True,
)

MIRROR_CATALOG = """{
    "table": {"namespace": "default", "name": "orders", "tableCoder": "mirror"},
    "rowkey": "key",
    "columns": {
        "o_orderkey": {"cf": "rowkey", "col": "key", "type": "bigint"},
        "o_orderpriority": {"cf": "o", "col": "priority", "type": "string"},
        "o_custkey": {"cf": "o", "col": "custkey", "type": "bigint"}
    }
}"""


@query("custom_codec", "SELECT o_orderkey, o_orderpriority, o_custkey FROM orders")
def custom_codec(spark, d):
    catalog = parse_catalog(MIRROR_CATALOG, codecs={"mirror": MIRROR})
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return read_table(write_table(rows, catalog, ts=JAN15), catalog)


ORDER_BINARY_CATALOG = """{
    "table": {"namespace": "default", "name": "orders", "version": "2.0", "tableCoder": "Phoenix"},
    "rowkey": "priority:order",
    "columns": {
        "o_orderpriority": {"cf": "rowkey", "col": "priority", "type": "string"},
        "o_orderkey": {"cf": "rowkey", "col": "order", "type": "bigint"},
        "o_totalprice": {"cf": "p", "col": "total", "type": "double"},
        "o_orderstatus": {"cf": "s", "col": "status", "type": "string"},
        "o_custkey": {"cf": "s", "col": "customer", "type": "bigint"}
    }
}"""


@query(
    "write_read_table",
    "SELECT o_orderpriority, o_orderkey, o_totalprice, o_orderstatus, o_custkey FROM orders",
)
def write_read_table(spark, d):
    catalog = parse_catalog(ORDER_BINARY_CATALOG)
    rows = table(spark, d, "orders").select(*[c.name for c in catalog.columns])
    return read_table(write_table(rows, catalog, ts=JAN15), catalog)


# ---- writes -------------------------------------------------------------------------------------


@query("write_cells", sql("SELECT row_key, family, qualifier, ts, seq, value FROM order_cells", "order_cells"))
def write_cells(spark, d):
    return order_cells(spark, d)


@query(
    "write_dynamic_family",
    sql(
        f"""SELECT row_key, 'w' AS family, qualifier, CAST({JAN15} AS BIGINT) AS ts,
        arg_max(value, (ts, seq)) AS value FROM tagged_cells GROUP BY row_key, qualifier""",
        "tagged_cells",
    ),
)
def write_dynamic_family(spark, d):
    maps = reads.read_dynamic_family(tagged_cells(spark, d), "e")
    return writes.write_dynamic_family(maps, "row_key", "data", "w", JAN15)


_VERSIONS = """SELECT row_key, 'w' AS family, {qualifier}, ts, arg_max(value, seq) AS value
    FROM event_cells {where} GROUP BY row_key, qualifier, ts"""


@query(
    "write_version_map",
    sql(
        _VERSIONS.format(qualifier="'clicks' AS qualifier", where="WHERE qualifier = 'click'").replace(
            "row_key, qualifier, ts", "row_key, ts"
        ),
        "event_cells",
    ),
)
def write_version_map(spark, d):
    maps = reads.read_version_map(event_cells(spark, d), "e", "click")
    return writes.write_version_map(maps, "row_key", "data", "w", "clicks")


@query(
    "write_dynamic_versions",
    sql(_VERSIONS.format(qualifier="qualifier", where=""), "event_cells"),
)
def write_dynamic_versions(spark, d):
    maps = reads.read_dynamic_versions(event_cells(spark, d), "e")
    return writes.write_dynamic_versions(maps, "row_key", "data", "w")


@query(
    "write_at_timestamp",
    sql(
        f"""SELECT custkey AS row_key, 'o' AS family, 'priority' AS qualifier,
        CAST({MID2000} AS BIGINT) AS ts, priority AS value FROM customers WHERE priority IS NOT NULL""",
        "customers",
    ),
)
def write_at_timestamp(spark, d):
    cells = writes.write_cells(customers(spark, d), "custkey", {"priority": ("o", "priority")}, 0)
    return writes.write_at_timestamp(cells, MID2000)


_UPSERT = """SELECT * FROM order_cells WHERE ts >= {a} AND ts < {b}
    UNION ALL SELECT row_key, family, qualifier, ts, seq + 1000000000 AS seq, value || '*' AS value
    FROM order_cells WHERE ts >= {c} AND ts < {d}"""


@query(
    "upsert_cells",
    sql(
        """SELECT row_key, family, qualifier, ts, arg_max(value, seq) AS value FROM merged
        GROUP BY row_key, family, qualifier, ts""",
        "order_cells",
        merged=_UPSERT.format(a=ORDERS_1[0], b=ORDERS_1[1], c=ORDERS_2[0], d=ORDERS_2[1]),
    ),
)
def upsert_cells(spark, d):
    written = order_cells(spark, d, ORDERS_2).withColumns(
        {"seq": F.col("seq") + 1000000000, "value": F.concat("value", F.lit("*"))}
    )
    return writes.upsert_cells(order_cells(spark, d, ORDERS_1), written)


@query(
    "write_presplit", sql("SELECT row_key, family, qualifier, ts, seq, value FROM order_cells", "order_cells")
)
def write_presplit(spark, d):
    path = scratch_path(spark, "presplit")
    writes.write_presplit(order_cells(spark, d), path, 6)
    return read_cells(spark, path)


def _split_cases(partitions: int) -> str:
    cases = [
        f"WHEN encode(row_key) < '{''.join(f'\\x{b:02X}' for b in point)}'::BLOB THEN {i}"
        for i, point in enumerate(writes.presplit_points(partitions))
    ]
    return f"CASE {' '.join(cases)} ELSE {partitions - 1} END"


@query(
    "presplit_partitions",
    f"""SELECT partition, count(*) AS rows FROM (SELECT {_split_cases(8)} AS partition
        FROM (SELECT p_name AS row_key FROM part)) GROUP BY partition""",
)
def presplit_partitions(spark, d):
    keys = table(spark, d, "part").select(F.col("p_name").alias("row_key"))
    assigned = writes.assign_presplit(keys, 8)
    return assigned.groupBy("partition").agg(F.count(F.lit(1)).alias("rows"))


