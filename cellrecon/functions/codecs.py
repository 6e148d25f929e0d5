"""Whole-column encodings between typed columns and binary cells.

Three built-in coders:

``native``    big-endian fixed-width numbers, UTF-8 text, raw binary
``sortable``  the same widths, changed so that byte order equals value order
``record``    nested values serialized into one cell (:mod:`cellrecon.functions.record_bytes`)

Everything but floating point and records is built from Spark expressions and stays in generated code. Spark has
no expression for the bits of a float, so those types use Arrow batches with numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.functions.record_bytes import decode_record_bytes, encode_record_bytes
from cellrecon.functions.records import decode_record, encode_record

NATIVE = "native"
SORTABLE = "sortable"
RECORD = "record"

_INTEGER_BYTES = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}
_FLOAT_BYTES = {T.FloatType: 4, T.DoubleType: 8}
_LONG_SIGN_BIT = -(2**63)
_SEPARATOR = "\0"


@dataclass(frozen=True)
class Codec:
    """A pair of column functions ``(column, data_type) -> column``.

    ``keys`` tells whether a row key may be encoded with it, ``composite_keys`` whether several key
    parts may be joined into one, ``records`` whether it serializes nested values and may therefore
    stand beside the table's own coder.
    """

    encode: Callable[[Column, T.DataType], Column]
    decode: Callable[[Column, T.DataType], Column]
    keys: bool = False
    composite_keys: bool = False
    records: bool = False


@dataclass(frozen=True)
class KeyPart:
    """One part of a composite key; ``width`` None means that its length varies."""

    data_type: T.DataType
    width: int | None = None


def _unsupported(coder: str, dt: T.DataType) -> ValueError:
    return ValueError(f"coder {coder!r} does not support {dt.simpleString()}")


# ---- integers -----------------------------------------------------------------------------------


def _int_bytes(value: Column, width: int) -> Column:
    """The low ``width`` bytes of a bigint."""
    if width == 8:
        return F.unhex(F.lpad(F.hex(value), 16, "0"))
    # A one in front of the bytes keeps their leading zeros, which is cheaper than padding.
    space = 2 ** (8 * width)
    digits = F.hex(value.bitwiseAND(F.lit(space - 1)) + F.lit(space))
    return F.unhex(F.substring(digits, 2, 2 * width))


def _unsigned(cell: Column) -> Column:
    return F.conv(F.hex(cell), 16, 10).cast("bigint")


def _encode_int(value: Column, width: int, sortable: bool) -> Column:
    value = value.cast("bigint")
    if sortable:
        value = (
            value.bitwiseXOR(F.lit(_LONG_SIGN_BIT))
            if width == 8
            else value + F.lit(2 ** (8 * width - 1))
        )
    return _int_bytes(value, width)


def _of_width(cell: Column, width: int, value: Column) -> Column:
    """``value`` for cells of ``width`` bytes; any other cell fails the job instead of giving a wrong number."""
    wrong = F.raise_error(F.concat(F.lit(f"a cell should have {width} bytes, not "), F.octet_length(cell).cast("string")))
    return F.when(cell.isNull() | (F.octet_length(cell) == width), value).otherwise(wrong)


def _decode_int(cell: Column, width: int, sortable: bool) -> Column:
    return _of_width(cell, width, _int_of(cell, width, sortable))


def _int_of(cell: Column, width: int, sortable: bool) -> Column:
    if width == 8:
        value = F.conv(F.hex(cell), 16, -10).cast("bigint")
        return value.bitwiseXOR(F.lit(_LONG_SIGN_BIT)) if sortable else value
    half, unsigned = 2 ** (8 * width - 1), _unsigned(cell)
    if sortable:
        return unsigned - F.lit(half)
    return F.when(unsigned >= half, unsigned - F.lit(2 * half)).otherwise(unsigned)


# ---- floating point -----------------------------------------------------------------------------


def _float_encoder(width: int, sortable: bool):
    @F.arrow_udf(T.BinaryType())
    def encode(values: pa.Array) -> pa.Array:
        unsigned = np.dtype(f"u{width}").type
        bits = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
        bits = np.ascontiguousarray(bits, dtype=f"f{width}").view(unsigned)
        if sortable:
            sign = unsigned(1 << (8 * width - 1))
            bits = np.where(bits & sign, ~bits, bits | sign)
        data = pa.py_buffer(bits.astype(f">u{width}").tobytes())
        offsets = pa.py_buffer(np.arange(0, width * (len(bits) + 1), width, dtype=np.int32))
        cells = pa.Array.from_buffers(pa.binary(), len(bits), [None, offsets, data])
        return pc.if_else(pc.is_valid(values), cells, pa.scalar(None, pa.binary()))

    return encode


def _float_decoder(width: int, sortable: bool):
    @F.arrow_udf(T.DoubleType() if width == 8 else T.FloatType())
    def decode(cells: pa.Array) -> pa.Array:
        valid = pc.is_valid(cells)
        if pc.any(pc.not_equal(pc.binary_length(cells), width)).as_py():
            raise ValueError(f"a floating point cell does not have {width} bytes")
        unsigned = np.dtype(f"u{width}").type
        present = cells.cast(pa.binary()).drop_null()
        bits = np.zeros(0, dtype=unsigned)
        if len(present):
            _, offsets, data = present.buffers()
            first = np.frombuffer(offsets, dtype=np.int32)[present.offset]
            bits = np.frombuffer(data, f">u{width}", len(present), first).astype(unsigned)
        if sortable:
            sign = unsigned(1 << (8 * width - 1))
            bits = np.where(bits & sign, bits & ~sign, ~bits)
        out = np.zeros(len(cells), dtype=f"f{width}")
        mask = valid.to_numpy(zero_copy_only=False)
        out[mask] = bits.astype(unsigned).view(f"f{width}")
        return pa.array(out, mask=~mask)

    return decode


# ---- scalars ------------------------------------------------------------------------------------


def _encode_scalar(value: Column, dt: T.DataType, coder: str) -> Column:
    sortable = coder == SORTABLE
    if type(dt) in _INTEGER_BYTES:
        return _encode_int(value, _INTEGER_BYTES[type(dt)], sortable)
    if type(dt) in _FLOAT_BYTES:
        return _float_encoder(_FLOAT_BYTES[type(dt)], sortable)(value)
    if isinstance(dt, T.BooleanType):
        true = "01" if sortable else "FF"
        return F.unhex(F.when(value, F.lit(true)).when(~value, F.lit("00")))
    if isinstance(dt, T.StringType):
        return value.cast("binary")
    if isinstance(dt, T.BinaryType):
        return value
    raise _unsupported(coder, dt)


def _decode_scalar(cell: Column, dt: T.DataType, coder: str) -> Column:
    sortable = coder == SORTABLE
    if type(dt) in _INTEGER_BYTES:
        return _decode_int(cell, _INTEGER_BYTES[type(dt)], sortable).cast(dt)
    if type(dt) in _FLOAT_BYTES:
        return _float_decoder(_FLOAT_BYTES[type(dt)], sortable)(cell)
    if isinstance(dt, T.BooleanType):
        return _of_width(cell, 1, F.hex(cell) != "00")
    if isinstance(dt, T.StringType):
        return cell.cast("string")
    if isinstance(dt, T.BinaryType):
        return cell
    raise _unsupported(coder, dt)


def encode_native(value: Column, dt: T.DataType) -> Column:
    return _encode_scalar(value, dt, NATIVE)


def decode_native(cell: Column, dt: T.DataType) -> Column:
    return _decode_scalar(cell, dt, NATIVE)


def encode_sortable(value: Column, dt: T.DataType) -> Column:
    return _encode_scalar(value, dt, SORTABLE)


def decode_sortable(cell: Column, dt: T.DataType) -> Column:
    return _decode_scalar(cell, dt, SORTABLE)


_BUILTIN = {
    NATIVE: Codec(encode_native, decode_native, keys=True, composite_keys=True),
    SORTABLE: Codec(encode_sortable, decode_sortable, keys=True, composite_keys=True),
    RECORD: Codec(encode_record_bytes, decode_record_bytes, records=True),
}


def builtin_codec(name: str) -> Codec:
    return _BUILTIN[name]


def record_codec(schema: str | None = None) -> Codec:
    """Record cells in binary, by a record schema or by that of each column's type."""
    return Codec(
        encode=lambda value, dt: encode_record_bytes(value, dt, schema),
        decode=lambda cell, dt: decode_record_bytes(cell, dt, schema),
        records=True,
    )


#: Record cells as JSON text; passed to ``parse_catalog(codecs=...)`` under the name that a column's ``coder`` gives.
JSON_RECORDS = Codec(encode_record, decode_record, records=True)


# ---- composite keys -----------------------------------------------------------------------------


def natural_width(part: KeyPart) -> int | None:
    if part.width is not None:
        return part.width
    if isinstance(part.data_type, T.BooleanType):
        return 1
    return {**_INTEGER_BYTES, **_FLOAT_BYTES}.get(type(part.data_type))


def _check_parts(parts: Sequence[KeyPart], coder: str) -> list[int | None]:
    widths = [natural_width(p) for p in parts]
    if coder == NATIVE and any(w is None for w in widths[:-1]):
        raise ValueError("only the last part of a native composite key may vary in length")
    return widths


def _latin1(cell: Column) -> Column:
    """Binary as text with one character per byte."""
    return F.decode(cell, "ISO-8859-1")


def _whole_part(cell: Column, width: int | None, separated: bool) -> Column:
    """The part's bytes; a value that could not be read back fails instead of being stored."""
    if width is not None:
        wrong = F.octet_length(cell) != width
        return F.when(wrong, F.raise_error(F.lit(f"key part is not {width} bytes long"))).otherwise(
            cell
        )
    if separated:
        wrong = F.instr(_latin1(cell), _SEPARATOR) > 0
        message = F.lit("a key part before the last contains a zero byte")
        return F.concat(
            F.when(wrong, F.raise_error(message)).otherwise(cell), F.unhex(F.lit("00"))
        )
    return cell


def encode_composite_key(
    values: Sequence[Column], parts: Sequence[KeyPart], coder: str = SORTABLE
) -> Column:
    """Join key parts into one binary key.

    Fixed-width parts are simply concatenated. The sortable coder ends every part of varying length
    but the last with a zero byte; the native coder allows such a part only in the last place.
    """
    widths = _check_parts(parts, coder)
    last = len(parts) - 1
    pieces = []
    for i, (value, part, width) in enumerate(zip(values, parts, widths, strict=True)):
        cell = _encode_scalar(value, part.data_type, coder)
        declared = width if part.width is not None else None
        varies = width is None
        pieces.append(_whole_part(cell, declared, varies and i < last) if declared or varies else cell)
    return F.concat(*pieces)


def decode_composite_key(
    key: Column, parts: Sequence[KeyPart], coder: str = SORTABLE
) -> list[Column]:
    """Inverse of :func:`encode_composite_key`: one typed column per part."""
    widths = _check_parts(parts, coder)
    last = len(parts) - 1
    if all(w is not None for w in widths[:-1]):
        starts = [sum(w for w in widths[:i]) + 1 for i in range(len(parts))]
        fixed = sum(w for w in widths if w is not None)
        length = F.octet_length(key)
        fits = length == fixed if widths[-1] is not None else length >= fixed
        wrong = F.raise_error(F.concat(F.lit("a key cannot have "), length.cast("string"), F.lit(" bytes")))
        whole = F.when(key.isNull() | fits, key).otherwise(wrong.cast("binary"))
        cells = [
            F.substring(whole, start, width if width is not None else 2**31 - 1)
            for start, width in zip(starts, widths, strict=True)
        ]
    else:
        groups = [
            f"(.{{{w}}})" if w is not None else "(.*)" if i == last else r"([^\x00]*)\x00"
            for i, w in enumerate(widths)
        ]
        pattern, text = "(?s)^" + "".join(groups) + r"\z", _latin1(key)
        wrong = F.raise_error(F.lit("a key does not have the parts it should have"))
        whole = F.when(text.isNull() | text.rlike(pattern), text).otherwise(wrong)
        cells = [
            F.encode(F.regexp_extract(whole, pattern, i + 1), "ISO-8859-1")
            for i in range(len(parts))
        ]
    return [
        _decode_scalar(cell, part.data_type, coder)
        for cell, part in zip(cells, parts, strict=True)
    ]
