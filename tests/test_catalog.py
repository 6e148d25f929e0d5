from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from cellrecon import CatalogError, ReadOptions, Restrictive, parse_catalog
from cellrecon.functions.codecs import Codec
from cellrecon.functions.records import record_data_type

pytestmark = pytest.mark.usefixtures("spark")

VOYAGE = json.dumps(
    {
        "type": "record",
        "name": "Voyage",
        "fields": [
            {"name": "legs", "type": {"type": "array", "items": {
                "type": "record", "name": "Leg", "fields": [
                    {"name": "port", "type": "string"},
                    {"name": "hours", "type": ["float", "double"]},
                ]}}},
            {"name": "cargo", "type": {"type": "map", "values": ["int", "long"]}},
            {"name": "returning", "type": "boolean"},
            {"name": "flag", "type": ["null", {"type": "enum", "name": "Flag", "symbols": ["RED", "BLUE"]}]},
            {"name": "seal", "type": {"type": "fixed", "name": "Seal", "size": 6}},
        ],
    }
)


def catalog(columns, rowkey="key", table=None):
    table = {"namespace": "default", "name": "t", **(table or {})}
    return json.dumps({"table": table, "rowkey": rowkey, "columns": columns})


KEY = {"key": {"cf": "rowkey", "col": "key", "type": "string"}}


def test_schema_keeps_column_order():
    c = parse_catalog(
        catalog(
            {
                "z": {"cf": "f", "col": "z", "type": "int"},
                **KEY,
                "a": {"cf": "g", "col": "a", "type": "map<string,string>"},
            }
        )
    )
    assert c.schema.names == ["z", "key", "a"]
    assert c.schema["a"].dataType == T.MapType(T.StringType(), T.StringType())
    assert c.families == ["f", "g"]
    assert c.namespace == "default"


def test_column_without_family_is_a_key_column():
    c = parse_catalog(catalog({"key": {"col": "key", "type": "string"}}))
    assert [k.name for k in c.key] == ["key"]


def test_column_shapes():
    c = parse_catalog(
        catalog(
            {
                **KEY,
                "family": {"cf": "f", "col": "", "type": "map<string,int>"},
                "versions": {"cf": "f", "col": "v", "type": "map<bigint,double>"},
                "both": {"cf": "g", "col": "", "type": "map<string,map<bigint,string>>"},
            }
        )
    )
    assert c.column("family").is_dynamic and not c.column("family").is_dynamic_versions
    assert c.column("versions").is_version_map and not c.column("versions").is_dynamic
    assert c.column("both").is_dynamic_versions
    types = [c.column(n).cell_type for n in ("family", "versions", "both")]
    assert types == [T.IntegerType(), T.DoubleType(), T.StringType()]


def test_composite_key_and_leading_columns():
    c = parse_catalog(
        catalog(
            {
                "a": {"cf": "rowkey", "col": "k1", "type": "bigint"},
                "b": {"cf": "rowkey", "col": "k2", "type": "int"},
                "c": {"cf": "rowkey", "col": "k3", "type": "string"},
            },
            rowkey="k2:k1:k3",
        )
    )
    assert [k.name for k in c.key] == ["b", "a", "c"]
    assert [k.width for k in c.key] == [4, 8, None]
    assert [k.name for k in c.leading_key_columns(["a", "b"])] == ["b", "a"]
    assert c.leading_key_columns(["a", "c"]) == []


def test_only_the_last_native_key_part_may_vary():
    """A part of open length is told from the next one by nothing but its place at the end."""
    parts = {"ok": ("k1", "boolean"), "serial": ("k2", "binary"), "year": ("k3", "smallint")}
    columns = {n: {"cf": "rowkey", "col": q, "type": t} for n, (q, t) in parts.items()}
    for order in ("k1:k2:k3", "k2:k1:k3", "k2:k3:k1"):
        with pytest.raises(CatalogError, match="last part"):
            parse_catalog(catalog(columns, order))
        sortable = {"version": "2.0", "tableCoder": "Phoenix"}
        assert parse_catalog(catalog(columns, order, sortable)).is_composite
    assert [k.width for k in parse_catalog(catalog(columns, "k1:k3:k2")).key] == [1, 2, None]
    columns["serial"]["length"] = "12"
    assert [k.width for k in parse_catalog(catalog(columns, "k2:k1:k3")).key] == [12, 1, 2]


def test_key_without_column():
    with pytest.raises(CatalogError, match="maps to key part"):
        parse_catalog(catalog({"custid": {"cf": "d", "col": "custid", "type": "string"}}))


def test_version_two_needs_a_table_coder():
    with pytest.raises(CatalogError, match="tableCoder"):
        parse_catalog(catalog(KEY, table={"version": "2.0"}))
    with pytest.raises(CatalogError, match="invalid catalog version"):
        parse_catalog(catalog(KEY, table={"version": ".3"}))
    assert parse_catalog(catalog(KEY, table={"version": "1"})).table_coder == "native"


def test_coder_rules():
    other = {**KEY, "v": {"cf": "f", "col": "v", "type": "int", "coder": "Phoenix"}}
    with pytest.raises(CatalogError, match="mix"):
        parse_catalog(catalog(other))
    other["v"]["coder"] = "Avro"
    assert parse_catalog(catalog(other)).column("v").coder == "record"
    with pytest.raises(CatalogError, match="cannot encode a row key"):
        parse_catalog(catalog(KEY, table={"tableCoder": "Avro"}))
    with pytest.raises(CatalogError, match="unknown coder"):
        parse_catalog(catalog(KEY, table={"tableCoder": "com.example.Mine"}))


def test_user_made_record_coder_may_stand_beside_the_table_coder():
    mine = Codec(lambda c, dt: c.cast("binary"), lambda c, dt: c.cast("string"), records=True)
    columns = {**KEY, "v": {"cf": "f", "col": "v", "type": "string", "coder": "mine"}}
    assert parse_catalog(catalog(columns), codecs={"mine": mine}).column("v").coder == "mine"


def test_custom_coder_without_composite_keys():
    mine = Codec(lambda c, dt: c.cast("binary"), lambda c, dt: c.cast("string"), keys=True)
    columns = {n: {"cf": "rowkey", "col": n, "type": "string"} for n in ("a", "b")}
    text = catalog(columns, "a:b", {"tableCoder": "com.example.Mine"})
    with pytest.raises(CatalogError, match="composite"):
        parse_catalog(text, codecs={"com.example.Mine": mine})


def test_record_schema_by_option_name():
    columns = {**KEY, "trip": {"cf": "f", "col": "v", "avro": "voyages"}}
    c = parse_catalog(catalog(columns), {"voyages": VOYAGE})
    assert c.codec(c.column("trip").coder).records
    assert c.schema["trip"].dataType.simpleString() == (
        "struct<legs:array<struct<port:string,hours:double>>,cargo:map<string,bigint>,"
        "returning:boolean,flag:string,seal:binary>"
    )
    with pytest.raises(CatalogError, match="voyages"):
        parse_catalog(catalog(columns))


@pytest.mark.parametrize(
    ("schema", "expected"),
    [
        ('"int"', T.IntegerType()),
        ('["int", "long"]', T.LongType()),
        ('["null", "float", "double"]', T.DoubleType()),
        ('{"type": "array", "items": ["null", "string"]}', T.ArrayType(T.StringType(), True)),
        ('{"type": "map", "values": "bytes"}', T.MapType(T.StringType(), T.BinaryType(), False)),
        ('{"type": "enum", "name": "e", "symbols": ["A"]}', T.StringType()),
        ('{"type": "fixed", "name": "f", "size": 4}', T.BinaryType()),
    ],
)
def test_record_types(schema, expected):
    assert record_data_type(schema) == expected


def test_record_union_without_a_type():
    with pytest.raises(ValueError, match="union"):
        record_data_type('["int", "string"]')


def test_read_options():
    o = ReadOptions.from_options(
        {"minStamp": "0", "maxStamp": "100", "maxVersions": "3", "mergeToLatest": "false"}
    )
    assert (o.min_ts, o.max_ts, o.max_versions, o.merge_to_latest) == (0, 100, 3, False)
    assert o.restrictive is Restrictive.COLUMN
    assert ReadOptions.from_options({"timestamp": "7", "restrictive": "FAMILY"}).timestamp == 7
    for bad in (
        {"minStamp": "0"},
        {"timestamp": "1", "minStamp": "0", "maxStamp": "2"},
        {"maxVersions": "0"},
        {"restrictive": "none of these"},
        {"mergeToLatest": "maybe"},
    ):
        with pytest.raises(ValueError):
            ReadOptions.from_options(bad)
