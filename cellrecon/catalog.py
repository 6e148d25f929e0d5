"""Table catalogs: how the columns of a typed table map to cells.

A catalog is a JSON text::

    {"table": {"namespace": "default", "name": "customer_info"},
     "rowkey": "key",
     "columns": {"key": {"cf": "rowkey", "col": "key", "type": "string"},
                 "age": {"cf": "demographics", "col": "age", "type": "int"}}}

Column order is the order of the table's schema. A column with ``"cf": "rowkey"`` is a part of the
row key; ``rowkey`` lists the parts in key order, separated by colons.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

from cellrecon.functions.codecs import NATIVE, RECORD, SORTABLE, Codec, builtin_codec, record_codec
from cellrecon.functions.records import record_data_type

KEY_FAMILY = "rowkey"

# The coder names that catalogs use.
CODER_NAMES = {"PrimitiveType": NATIVE, "Phoenix": SORTABLE, "Avro": RECORD}

# Bytes taken by each fixed-width type.
FIXED_WIDTHS = {
    T.BooleanType(): 1,
    T.ByteType(): 1,
    T.ShortType(): 2,
    T.IntegerType(): 4,
    T.LongType(): 8,
    T.FloatType(): 4,
    T.DoubleType(): 8,
}


class CatalogError(ValueError):
    """The catalog text does not describe a usable table."""


@dataclass(frozen=True)
class Column:
    """One column of a typed table."""

    name: str
    family: str
    qualifier: str
    data_type: T.DataType
    coder: str
    length: int | None = None

    @property
    def is_key(self) -> bool:
        return self.family == KEY_FAMILY

    @property
    def width(self) -> int | None:
        """Declared or natural number of bytes, None when the value's length varies."""
        return self.length if self.length is not None else FIXED_WIDTHS.get(self.data_type)

    @property
    def is_version_map(self) -> bool:
        """``map<bigint,T>``: every selected version of one column."""
        return isinstance(self.data_type, T.MapType) and self.data_type.keyType == T.LongType()

    @property
    def is_dynamic(self) -> bool:
        """``map<string,...>`` without a qualifier: every column of the family."""
        return (
            not self.qualifier
            and isinstance(self.data_type, T.MapType)
            and self.data_type.keyType == T.StringType()
        )

    @property
    def is_dynamic_versions(self) -> bool:
        """``map<string,map<bigint,T>>``: every version of every column of the family."""
        return self.is_dynamic and (
            isinstance(self.data_type.valueType, T.MapType)
            and self.data_type.valueType.keyType == T.LongType()
        )

    @property
    def cell_type(self) -> T.DataType:
        """Type of a single cell's value."""
        if self.is_dynamic_versions:
            return self.data_type.valueType.valueType
        if self.is_dynamic or self.is_version_map:
            return self.data_type.valueType
        return self.data_type


@dataclass(frozen=True)
class Catalog:
    namespace: str
    name: str
    columns: tuple[Column, ...]
    key: tuple[Column, ...]
    table_coder: str
    codecs: Mapping[str, Codec]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.data_type) for c in self.columns])

    @property
    def value_columns(self) -> list[Column]:
        return [c for c in self.columns if not c.is_key]

    @property
    def families(self) -> list[str]:
        return list(dict.fromkeys(c.family for c in self.value_columns))

    @property
    def is_composite(self) -> bool:
        return len(self.key) > 1

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise CatalogError(f"no column {name!r} in the catalog of {self.name!r}")

    def select(self, names: list[str] | None) -> list[Column]:
        """The named columns in the requested order, or all of them."""
        return list(self.columns) if names is None else [self.column(n) for n in names]

    def codec(self, coder: str) -> Codec:
        return self.codecs[coder]

    def leading_key_columns(self, names: list[str]) -> list[Column]:
        """The longest run of key parts, from the first on, that are all among ``names``.

        Only these can narrow a scan: a range on a later part leaves the key order open.
        """
        run = []
        for part in self.key:
            if part.name not in names:
                break
            run.append(part)
        return run


def _version(text: str) -> tuple[int, int]:
    if not re.fullmatch(r"[0-9]{1,9}(\.[0-9]{1,9})?", text):
        raise CatalogError(f"invalid catalog version {text!r}")
    major, _, minor = text.partition(".")
    return int(major), int(minor or 0)


def _table_coder(table: Mapping) -> str:
    coder = table.get("tableCoder")
    if coder is None:
        if _version(str(table.get("version", "1.0"))) >= (2, 0):
            raise CatalogError("a catalog of version 2.0 or later has to name its tableCoder")
        return NATIVE
    _version(str(table.get("version", "1.0")))
    return CODER_NAMES.get(coder, coder)


def _record_coder(option: str) -> str:
    """The name of the coder for a record schema that an option holds."""
    return f"{RECORD} {option}"


def _column(name: str, spec: Mapping, table_coder: str, options: Mapping[str, str]) -> Column:
    if "col" not in spec:
        raise CatalogError(f"column {name!r} has no 'col'")
    if "avro" in spec:
        if spec["avro"] not in options:
            raise CatalogError(f"column {name!r}: no option {spec['avro']!r} with its schema")
        data_type, coder = record_data_type(options[spec["avro"]]), _record_coder(spec["avro"])
    elif "type" in spec:
        data_type = T.StructType.fromDDL(f"v {spec['type']}")["v"].dataType
        coder = CODER_NAMES.get(spec.get("coder"), spec.get("coder")) or table_coder
    else:
        raise CatalogError(f"column {name!r} has neither 'type' nor 'avro'")
    length = int(spec["length"]) if "length" in spec else None
    if length == -1:
        length = None
    return Column(name, spec.get("cf", KEY_FAMILY), spec["col"], data_type, coder, length)


def _key_parts(rowkey: str, columns: list[Column]) -> list[Column]:
    by_qualifier = {c.qualifier: c for c in columns if c.is_key}
    missing = [k for k in rowkey.split(":") if k not in by_qualifier]
    if missing:
        raise CatalogError(f"no column of family '{KEY_FAMILY}' maps to key part {missing}")
    return [by_qualifier[k] for k in rowkey.split(":")]


def _validate(key: list[Column], coders: set[str], table_coder: str, codecs: Mapping) -> None:
    unknown = sorted(c for c in coders if c not in codecs)
    if unknown:
        raise CatalogError(f"unknown coder {unknown}; pass it in codecs=")
    if table_coder == NATIVE and any(part.width is None for part in key[:-1]):
        raise CatalogError(
            "only the last part of the row key may vary in length; give the others a 'length'"
        )
    if not codecs[table_coder].keys:
        raise CatalogError(f"coder {table_coder!r} cannot encode a row key")
    if len(coders) > 1 and not any(codecs[c].records for c in coders):
        raise CatalogError(f"one table cannot mix the coders {sorted(coders)}")
    if len(key) > 1 and not codecs[table_coder].composite_keys:
        raise CatalogError(f"coder {table_coder!r} cannot encode a composite row key")


def parse_catalog(
    text: str,
    options: Mapping[str, str] | None = None,
    codecs: Mapping[str, Codec] | None = None,
) -> Catalog:
    """Read and validate a catalog.

    ``options`` holds the record schemas that ``"avro"`` entries refer to by name; ``codecs`` adds
    user-made codecs by the name the catalog uses for them.
    """
    doc = json.loads(text)
    known = {name: builtin_codec(name) for name in (NATIVE, SORTABLE, RECORD)}
    known.update({_record_coder(name): record_codec(schema) for name, schema in (options or {}).items()})
    known.update(codecs or {})
    try:
        table, rowkey, specs = doc["table"], doc["rowkey"], doc["columns"]
        name = table["name"]
    except KeyError as e:
        raise CatalogError(f"the catalog lacks {e}") from None
    table_coder = _table_coder(table)
    columns = [_column(n, s, table_coder, options or {}) for n, s in specs.items()]
    key = _key_parts(rowkey, columns)
    _validate(key, {table_coder, *(c.coder for c in columns)}, table_coder, known)
    return Catalog(
        table.get("namespace", "default"), name, tuple(columns), tuple(key), table_coder, known
    )
