"""Record cells in binary: a schema says what the bytes of a value are, and nothing else is stored.

The layout is the public one of Avro's binary encoding: integers as zigzag numbers of seven bits a byte, floating point
little-endian, text and bytes behind their length, lists and maps in blocks behind their count and ended by an empty
one, a union behind the number of its member, an enum as the number of its symbol, records as their fields in order.

Whole columns are encoded and decoded at once. A column's bytes are kept as one buffer with a length for each row, so a
field is one pass of array arithmetic, and putting fields together is one scatter; reading moves a position for each row
through the column's buffer. Only lists and maps take a round for each item of the longest one.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.functions.records import from_stored, record_data_type, stored_type, to_stored

# The names of scalar types in a schema.
_NUMBERS = {"int": "<i4", "long": "<i8"}
_FLOATS = {"float": "<f4", "double": "<f8"}
_ARROW = {
    "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(),
    "string": pa.string(), "enum": pa.string(), "bytes": pa.binary(), "fixed": pa.binary(),
}


@dataclass(frozen=True)
class _Node:
    """One node of a schema. ``kind`` is a scalar's name, record, list, map or union."""

    kind: str
    names: tuple[str, ...] = ()
    inner: tuple[_Node, ...] = ()
    symbols: tuple[str, ...] = ()
    size: int = 0
    #: Of a union: which of its members stands for null, -1 if none does.
    null: int = field(default=-1)


def _parse(schema, known: dict[str, _Node]) -> _Node:
    if isinstance(schema, list):
        null = schema.index("null") if "null" in schema else -1
        members = tuple(_Node("null") if m == "null" else _parse(m, known) for m in schema)
        return _Node("union", inner=members, null=null)
    kind = schema if isinstance(schema, str) else schema["type"]
    if isinstance(kind, (list, dict)):
        return _parse(kind, known)
    if kind in known:
        return known[kind]
    if kind == "record":
        fields = schema["fields"]
        node = _Node("record", tuple(f["name"] for f in fields), tuple(_parse(f["type"], known) for f in fields))
    elif kind == "array":
        return _Node("list", inner=(_parse(schema["items"], known),))
    elif kind == "map":
        return _Node("map", inner=(_parse(schema["values"], known),))
    elif kind == "enum":
        node = _Node("enum", symbols=tuple(schema["symbols"]))
    elif kind == "fixed":
        node = _Node("fixed", size=int(schema["size"]))
    elif kind in _ARROW:
        return _Node(kind)
    else:
        raise ValueError(f"record schema type {kind!r} is not supported")
    if "name" in schema:
        known[schema["name"]] = node
    return node


def schema_of(dt: T.DataType, nullable: bool = False, name: str = "value") -> object:
    """The schema that a value of a Spark type is stored by; what may be missing is a union with null."""
    plain = stored_type(dt)
    scalars = {
        T.BooleanType: "boolean", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float",
        T.DoubleType: "double", T.StringType: "string", T.BinaryType: "bytes",
    }
    if isinstance(dt, T.StructType):
        fields = [{"name": f.name, "type": schema_of(f.dataType, f.nullable, f"{name}_{f.name}")} for f in dt.fields]
        schema: object = {"type": "record", "name": name, "fields": fields}
    elif isinstance(dt, T.ArrayType):
        schema = {"type": "array", "items": schema_of(dt.elementType, dt.containsNull, f"{name}_item")}
    elif isinstance(dt, T.MapType):
        schema = {"type": "map", "values": schema_of(dt.valueType, dt.valueContainsNull, f"{name}_value")}
    else:
        schema = scalars[type(plain)]
    return [schema, "null"] if nullable else schema


# ---- writing ------------------------------------------------------------------------------------


@dataclass
class _Piece:
    """A buffer and how many bytes of it each row has."""

    lengths: np.ndarray
    data: np.ndarray


def _joined(pieces: Sequence[_Piece]) -> _Piece:
    """The pieces of each row one after the other."""
    if len(pieces) == 1:
        return pieces[0]
    lengths = np.sum([p.lengths for p in pieces], axis=0)
    out = np.empty(int(lengths.sum()), np.uint8)
    start = np.cumsum(lengths) - lengths
    for p in pieces:
        source = np.cumsum(p.lengths) - p.lengths
        out[np.repeat(start - source, p.lengths) + np.arange(len(p.data))] = p.data
        start = start + p.lengths
    return _Piece(lengths, out)


def _numbers(values: np.ndarray) -> _Piece:
    values = values.astype(np.int64)
    zigzag = ((values << 1) ^ (values >> 63)).view(np.uint64)
    lengths = np.ones(len(values), np.int64)
    for k in range(1, 10):
        lengths += zigzag >= np.uint64(1) << np.uint64(7 * k)
    widest = int(lengths.max()) if len(lengths) else 1
    places = np.arange(widest, dtype=np.uint64)
    digits = ((zigzag[:, None] >> (places * np.uint64(7))) & np.uint64(0x7F)).astype(np.uint8)
    inside = np.arange(widest) < lengths[:, None]
    digits |= (np.arange(widest) < lengths[:, None] - 1).astype(np.uint8) << 7
    return _Piece(lengths, digits[inside])


def _raw(array: pa.Array) -> _Piece:
    """The bytes of a text or binary column."""
    if not len(array):  # which need not have offsets
        return _Piece(np.zeros(0, np.int64), np.zeros(0, np.uint8))
    array = array.cast(pa.large_binary()) if not pa.types.is_large_binary(array.type) else array
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    bytes_ = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(array) else np.zeros(0, np.uint8)
    return _Piece(np.diff(at), bytes_)


def _fixed_width(values: np.ndarray, width: int) -> _Piece:
    return _Piece(np.full(len(values), width, np.int64), np.ascontiguousarray(values).view(np.uint8).reshape(-1))


def _write(node: _Node, array: pa.Array) -> _Piece:
    if not len(array):
        return _Piece(np.zeros(0, np.int64), np.zeros(0, np.uint8))
    if node.kind == "union":
        return _write_union(node, array)
    if array.null_count:
        raise ValueError(f"a missing value where the schema has {node.kind} without null")
    if node.kind in _NUMBERS:
        return _numbers(array.to_numpy(zero_copy_only=False))
    if node.kind in _FLOATS:
        values = array.to_numpy(zero_copy_only=False).astype(_FLOATS[node.kind])
        return _fixed_width(values, values.dtype.itemsize)
    if node.kind == "boolean":
        return _fixed_width(array.to_numpy(zero_copy_only=False).astype(np.uint8), 1)
    if node.kind in ("string", "bytes"):
        raw = _raw(array)
        return _joined([_numbers(raw.lengths), raw])
    if node.kind == "fixed":
        raw = _raw(array)
        if (raw.lengths != node.size).any():
            raise ValueError(f"a value of fixed size does not have {node.size} bytes")
        return raw
    if node.kind == "enum":
        at = pc.index_in(array, pa.array(node.symbols, pa.string()))
        if at.null_count:
            raise ValueError(f"a value is none of {list(node.symbols)}")
        return _numbers(at.to_numpy(zero_copy_only=False))
    if node.kind == "record":
        fields = [_write(n, pc.struct_field(array, name)) for name, n in zip(node.names, node.inner, strict=True)]
        return _joined(fields) if fields else _Piece(np.zeros(len(array), np.int64), np.zeros(0, np.uint8))
    offsets = np.asarray(array.offsets.to_numpy(zero_copy_only=False), np.int64)
    low, high = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    if node.kind == "list":
        items = _write(node.inner[0], array.values.slice(low, high - low))
    else:
        pairs = [_write(_Node("string"), array.keys.slice(low, high - low)), _write(node.inner[0], array.items.slice(low, high - low))]
        items = _joined(pairs)
    ends = np.concatenate([[0], np.cumsum(items.lengths)])
    counts = np.diff(offsets)
    of_row = _Piece(ends[offsets[1:] - low] - ends[offsets[:-1] - low], items.data)
    some = counts > 0
    head = _numbers(counts[some])
    heads = _Piece(_spread(head.lengths, some), head.data)
    closing = _Piece(np.ones(len(counts), np.int64), np.zeros(len(counts), np.uint8))
    return _joined([heads, of_row, closing])


def _spread(lengths: np.ndarray, where: np.ndarray) -> np.ndarray:
    out = np.zeros(len(where), np.int64)
    out[where] = lengths
    return out


def _member(node: _Node) -> int:
    """The member of a union that values are written as: the wider of two numbers."""
    others = [i for i, m in enumerate(node.inner) if i != node.null]
    for wide in ("long", "double"):
        if len(others) > 1 and wide in [node.inner[i].kind for i in others]:
            return next(i for i in others if node.inner[i].kind == wide)
    return others[0]


def _write_union(node: _Node, array: pa.Array) -> _Piece:
    valid = pc.is_valid(array).to_numpy(zero_copy_only=False)
    if node.null < 0 and not valid.all():
        raise ValueError("a missing value where the schema has a union without null")
    chosen = _member(node)
    tags = _numbers(np.where(valid, chosen, node.null))
    found = _write(node.inner[chosen], array.filter(pa.array(valid)) if not valid.all() else array)
    return _joined([tags, _Piece(_spread(found.lengths, valid), found.data)])


# ---- reading ------------------------------------------------------------------------------------


class _Reader:
    """The bytes of a column and where each row's end; positions are handed from field to field."""

    def __init__(self, data: np.ndarray):
        # Beyond the last byte there are zeros, so that a cell cut short is noticed and not run over.
        self.data = np.concatenate([data, np.zeros(16, np.uint8)])

    def _inside(self, ok: np.ndarray) -> None:
        if not ok.all():
            raise ValueError("a record cell ends before its value does")

    def numbers(self, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value, at, open_ = np.zeros(len(at), np.uint64), at.copy(), np.arange(len(at))
        for k in range(10):
            self._inside(at[open_] < end[open_])
            byte = self.data[at[open_]]
            value[open_] |= (byte & 0x7F).astype(np.uint64) << np.uint64(7 * k)
            at[open_] += 1
            open_ = open_[byte >= 0x80]
            if not len(open_):
                break
        else:
            raise ValueError("a number in a record cell has more than ten bytes")
        return ((value >> np.uint64(1)).view(np.int64) ^ -(value & np.uint64(1)).view(np.int64)), at

    def bytes_(self, at: np.ndarray, lengths: np.ndarray, end: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        self._inside((lengths >= 0) & (lengths <= end - at))
        total = int(lengths.sum())
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        index = np.repeat(at - offsets[:-1], lengths) + np.arange(total)
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[index])]
        return pa.Array.from_buffers(pa.large_binary(), len(at), buffers).cast(pa.binary()), at + lengths

    def fixed_width(self, at: np.ndarray, kind: str, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = np.dtype(kind).itemsize
        self._inside(at + width <= end)
        return self.data[at[:, None] + np.arange(width)].reshape(-1).view(kind), at + width


def _read(node: _Node, r: _Reader, at: np.ndarray, end: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    if node.kind == "union":
        return _read_union(node, r, at, end)
    if node.kind in _NUMBERS:
        value, at = r.numbers(at, end)
        return pa.array(value).cast(_ARROW[node.kind]), at
    if node.kind in _FLOATS:
        value, at = r.fixed_width(at, _FLOATS[node.kind], end)
        return pa.array(value), at
    if node.kind == "boolean":
        value, at = r.fixed_width(at, "u1", end)
        return pa.array(value != 0), at
    if node.kind in ("string", "bytes"):
        lengths, at = r.numbers(at, end)
        value, at = r.bytes_(at, lengths, end)
        return value.cast(_ARROW[node.kind]), at
    if node.kind == "fixed":
        return r.bytes_(at, np.full(len(at), node.size, np.int64), end)
    if node.kind == "enum":
        number, at = r.numbers(at, end)
        if ((number < 0) | (number >= len(node.symbols))).any():
            raise ValueError("a record cell has a symbol that its schema lacks")
        return pa.array(node.symbols, pa.string()).take(pa.array(number)), at
    if node.kind == "record":
        found = []
        for n in node.inner:
            value, at = _read(n, r, at, end)
            found.append(value)
        if not found:
            return pa.array([{}] * len(at), pa.struct([])), at
        return pa.StructArray.from_arrays(found, node.names), at
    return _read_items(node, r, at, end)


def _read_items(node: _Node, r: _Reader, at: np.ndarray, end: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    at, n = at.copy(), len(at)
    left, open_ = np.zeros(n, np.int64), np.arange(n)
    parts = [node.inner[0]] if node.kind == "list" else [_Node("string"), node.inner[0]]
    rows: list[np.ndarray] = []
    found: list[list[pa.Array]] = [[] for _ in parts]
    while len(open_):
        fresh = open_[left[open_] == 0]
        if len(fresh):
            counts, at[fresh] = r.numbers(at[fresh], end[fresh])
            sized = fresh[counts < 0]  # a negative count is followed by the block's size in bytes
            if len(sized):
                _, at[sized] = r.numbers(at[sized], end[sized])
            left[fresh] = np.abs(counts)
            open_ = np.concatenate([open_[left[open_] > 0]])
            if not len(open_):
                break
        for k, part in enumerate(parts):
            value, at[open_] = _read(part, r, at[open_], end[open_])
            found[k].append(value)
        rows.append(open_)
        left[open_] -= 1
    owners = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    order = pa.array(np.argsort(owners, kind="stable"))
    values = [
        pa.concat_arrays(f).take(order) if f else pa.array([], _arrow_type(part)) for f, part in zip(found, parts, strict=True)
    ]
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))]).astype(np.int32))
    if node.kind == "list":
        return pa.ListArray.from_arrays(offsets, values[0]), at
    return pa.MapArray.from_arrays(offsets, *values), at


def _read_union(node: _Node, r: _Reader, at: np.ndarray, end: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    tags, at = r.numbers(at, end)
    if ((tags < 0) | (tags >= len(node.inner))).any():
        raise ValueError("a record cell has a member of a union that its schema lacks")
    kind, at = _arrow_type(node), at.copy()
    pieces, owners = [pa.array([], kind)], [np.zeros(0, np.int64)]
    for i, member in enumerate(node.inner):
        here = np.flatnonzero(tags == i)
        if i != node.null and len(here):
            value, at[here] = _read(member, r, at[here], end[here])
            pieces.append(value.cast(kind) if value.type != kind else value)
            owners.append(here)
    place = np.full(len(at), -1)
    place[np.concatenate(owners)] = np.arange(sum(map(len, owners)))
    whole = pa.concat_arrays(pieces)
    return whole.take(pa.array(place, mask=place < 0)), at


def _arrow_type(node: _Node) -> pa.DataType:
    if node.kind == "union":
        return _arrow_type(node.inner[_member(node)])
    if node.kind == "record":
        return pa.struct([(n, _arrow_type(i)) for n, i in zip(node.names, node.inner, strict=True)])
    if node.kind == "list":
        return pa.list_(_arrow_type(node.inner[0]))
    if node.kind == "map":
        return pa.map_(pa.string(), _arrow_type(node.inner[0]))
    return _ARROW[node.kind]


# ---- columns ------------------------------------------------------------------------------------


def _node(dt: T.DataType, schema: str | None) -> _Node:
    return _parse(json.loads(schema) if schema is not None else schema_of(dt), {})


def encode_record_bytes(value: Column, dt: T.DataType, schema: str | None = None) -> Column:
    """One binary cell for each value, by a record schema (JSON text) or by that of the type; null stays null."""
    node = _node(dt, schema)
    if schema is not None and record_data_type(schema) != dt and stored_type(dt) != record_data_type(schema):
        raise ValueError(f"the record schema does not hold {dt.simpleString()}")

    @F.arrow_udf(T.BinaryType())
    def encode(values: pa.Array) -> pa.Array:
        valid = pc.is_valid(values)
        present = values.filter(valid) if values.null_count else values
        piece = _write(node, present)
        where = valid.to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(_spread(piece.lengths, where))])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(piece.data))]
        cells = pa.Array.from_buffers(pa.large_binary(), len(where), buffers).cast(pa.binary())
        return pc.if_else(valid, cells, pa.scalar(None, pa.binary()))

    return encode(to_stored(value, dt))


def decode_record_bytes(cell: Column, dt: T.DataType, schema: str | None = None) -> Column:
    """Inverse of :func:`encode_record_bytes`. A cell that is too short or too long fails the job."""
    node = _node(dt, schema)

    @F.arrow_udf(stored_type(dt))
    def decode(cells: pa.Array) -> pa.Array:
        where = pc.is_valid(cells).to_numpy(zero_copy_only=False)
        present = _raw(cells.drop_null())
        end = np.cumsum(present.lengths)
        found, at = _read(node, _Reader(present.data), end - present.lengths, end)
        if (at != end).any():
            raise ValueError("a record cell goes on behind its value")
        place = np.full(len(where), -1)
        place[where] = np.arange(int(where.sum()))
        return found.take(pa.array(place, mask=~where))

    return from_stored(decode(cell), dt)
