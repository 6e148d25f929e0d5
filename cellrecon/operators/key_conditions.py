"""Conditions on the parts of an encoded row key, as byte ranges that a scan can skip by.

A stored key is bytes; a condition speaks of typed parts. Spark cannot look through the decoding, so
the conditions are compiled here into half-open byte ranges of the whole key:

* values for the first parts fix a prefix, a list of values several prefixes (a list times the list of
  the next part), so that a condition behind a list on the leading part still skips what lies between;
* a range on the next part is a byte range behind each prefix. Where bytes don't sort like values, as
  native numbers of both signs, it is one byte range for each sign;
* the first part without a condition ends this; conditions behind it narrow nothing.

The byte ranges hold every key that meets the conditions, and may hold others (too many prefixes are
widened to fewer ranges). Reads therefore test the typed parts as well.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.functions.codecs import NATIVE, SORTABLE, KeyPart, natural_width

#: A scan gets at most so many byte ranges.
MOST_RANGES = 512

_INTEGER_BYTES = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}
_FLOAT_BYTES = {T.FloatType: 4, T.DoubleType: 8}

ByteRange = tuple[bytes, bytes | None]


@dataclass(frozen=True)
class KeyCondition:
    """What one part of a key is to be: one of ``values``, or within a range whose open sides are None."""

    column: str
    values: tuple | None = None
    low: Any = None
    high: Any = None
    low_inclusive: bool = True
    high_inclusive: bool = False

    def of(self, value: Column) -> Column:
        """The condition on the typed value; a null meets none."""
        if self.values is not None:
            return value.isin([F.lit(v) for v in self.values if v is not None])
        condition = value.isNotNull()
        if self.low is not None:
            condition &= value >= F.lit(self.low) if self.low_inclusive else value > F.lit(self.low)
        if self.high is not None:
            condition &= value <= F.lit(self.high) if self.high_inclusive else value < F.lit(self.high)
        return condition


def key_equals(column: str, value: Any) -> KeyCondition:
    return KeyCondition(column, (value,))


def key_in(column: str, values: Sequence) -> KeyCondition:
    return KeyCondition(column, tuple(values))


def key_between(
    column: str, low: Any = None, high: Any = None, low_inclusive: bool = True, high_inclusive: bool = False
) -> KeyCondition:
    return KeyCondition(column, None, low, high, low_inclusive, high_inclusive)


def prefix_end(prefix: bytes) -> bytes | None:
    """The least key greater than all keys that start with ``prefix``; None if there is none."""
    kept = prefix.rstrip(b"\xff")
    return kept[:-1] + bytes([kept[-1] + 1]) if kept else None


# ---- one part -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Piece:
    """A byte range within a part; ``point`` is given where it holds exactly the keys that go on from these bytes."""

    start: bytes
    end: bytes | None
    point: bytes | None = None


def _point(data: bytes, open_ended: bool) -> _Piece:
    # The last part of varying length is the value itself and nothing that begins like it.
    return _Piece(data, data + b"\0" if open_ended else prefix_end(data), None if open_ended else data)


def _int_bytes(value: int, width: int, coder: str) -> bytes:
    return (value + 2 ** (8 * width - 1) if coder == SORTABLE else value % 2 ** (8 * width)).to_bytes(width)


def _number(value: Any) -> Any:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, np.integer, np.floating)):
        raise ValueError(f"{value!r} is no number to compare a key part with")
    return value


def _int_pieces(width: int, coder: str, c: KeyCondition) -> list[_Piece]:
    least, most = -(2 ** (8 * width - 1)), 2 ** (8 * width - 1) - 1
    if c.values is not None:
        numbers = [_number(v) for v in c.values if v is not None]
        whole = sorted({int(v) for v in numbers if math.isfinite(v) and v == int(v) and least <= v <= most})
        return [_point(_int_bytes(v, width, coder), False) for v in whole]
    low, high = least, most
    if c.low is not None:
        bound = _number(c.low)
        if math.isnan(bound) or bound == math.inf:
            return []
        if bound != -math.inf:
            low = max(low, math.ceil(bound) + (not c.low_inclusive and bound == math.ceil(bound)))
    if c.high is not None:
        bound = _number(c.high)
        if bound == -math.inf:
            return []
        if math.isfinite(bound):
            high = min(high, math.floor(bound) - (not c.high_inclusive and bound == math.floor(bound)))
    runs = [(low, high)]
    if coder == NATIVE and low < 0 <= high:
        runs = [(0, high), (low, -1)]
    return [
        _Piece(_int_bytes(a, width, coder), prefix_end(_int_bytes(b, width, coder))) for a, b in runs if a <= b
    ]


def _float_bytes(value: float, width: int, coder: str) -> bytes:
    data = struct.pack(">d" if width == 8 else ">f", value)
    if coder == NATIVE:
        return data
    bits, sign = int.from_bytes(data), 1 << (8 * width - 1)
    return (bits ^ (2 * sign - 1) if bits & sign else bits | sign).to_bytes(width)


def _float_pieces(width: int, coder: str, c: KeyCondition) -> list[_Piece]:
    kind = np.float64 if width == 8 else np.float32

    def near(value: Any) -> float:
        with np.errstate(over="ignore"):
            return float(kind(value))

    def after(value: float, toward: float) -> float:
        return float(np.nextafter(kind(value), kind(toward)))

    bounds = c.values if c.values is not None else (c.low, c.high)
    if any(v is not None and math.isnan(_number(v)) for v in bounds):
        return [_Piece(b"", None)]
    if c.values is not None:
        found = [near(v) for v in c.values if v is not None and near(v) == v]
        # Both zeros are one value.
        stored = {_float_bytes(x, width, coder) for v in found for x in ((0.0, -0.0) if v == 0 else (v,))}
        return [_point(s, False) for s in sorted(stored)]
    low, high = -math.inf, math.inf
    if c.low is not None:
        low = near(c.low)
        # The least stored number that the condition takes; both zeros are one value.
        if low < c.low or (low == c.low and not c.low_inclusive):
            low = after(low, math.inf) if low != math.inf else None
        if low is None or (low == math.inf and c.low == math.inf and not c.low_inclusive):
            return _not_a_number(width, coder) if c.high is None else []
        if low == 0:
            low = -0.0
    if c.high is not None:
        high = near(c.high)
        if high > c.high or (high == c.high and not c.high_inclusive):
            if high == -math.inf:
                return []
            high = after(high, -math.inf)
        if high == 0:
            high = 0.0
    pieces = _not_a_number(width, coder) if c.high is None else []
    if low > high:
        return pieces

    def data(v: float) -> bytes:
        return _float_bytes(v, width, coder)

    if coder == SORTABLE:
        return pieces + [_Piece(data(low), prefix_end(data(high)))]
    negative_zero = data(-0.0)
    if math.copysign(1, high) > 0:
        from_zero = low if math.copysign(1, low) > 0 else 0.0
        pieces.append(_Piece(data(from_zero), prefix_end(data(high))))
    if math.copysign(1, low) < 0:
        upper = data(high) if math.copysign(1, high) < 0 else negative_zero
        pieces.append(_Piece(upper, prefix_end(data(low))))
    return pieces


def _not_a_number(width: int, coder: str) -> list[_Piece]:
    """NaN of either sign, which Spark sorts above all numbers."""
    top, bottom = (_float_bytes(v, width, coder) for v in (math.inf, -math.inf))
    if coder == SORTABLE:
        return [_Piece(prefix_end(top), None), _Piece(b"", bottom)]
    return [_Piece(prefix_end(top), b"\x80"), _Piece(prefix_end(bottom), None)]


def _text_pieces(width: int | None, separated: bool, last: bool, c: KeyCondition) -> list[_Piece]:
    def data(value: Any) -> bytes:
        if isinstance(value, str):
            return value.encode()
        if isinstance(value, (bytes, bytearray)):
            return bytes(value)
        raise ValueError(f"{value!r} is neither text nor bytes")

    end = b"\0" if separated else b""
    open_ended = last and width is None
    if c.values is not None:
        values = sorted({data(v) for v in c.values if v is not None})
        if width is not None:
            values = [v for v in values if len(v) == width]
        return [_point(v + end, open_ended) for v in values]

    def cut(value: Any, inclusive: bool, is_low: bool) -> bytes | None:
        """Where the range begins or ends."""
        bound = data(value)
        if width is not None and len(bound) != width:
            # No part equals the bound: a shorter one lies before all that begin with it, a longer one behind its head.
            return bound if len(bound) < width else prefix_end(bound[:width])
        piece = _point(bound + end, open_ended)
        return piece.start if inclusive == is_low else piece.end

    start = b"" if c.low is None else cut(c.low, c.low_inclusive, True)
    stop = None if c.high is None else cut(c.high, c.high_inclusive, False)
    if start is None or (stop is not None and start >= stop):
        return []
    return [_Piece(start, stop)]


def _pieces(part: KeyPart, coder: str, last: bool, c: KeyCondition) -> list[_Piece]:
    dt, width = part.data_type, natural_width(part)
    if type(dt) in _INTEGER_BYTES:
        return _int_pieces(_INTEGER_BYTES[type(dt)], coder, c)
    if type(dt) in _FLOAT_BYTES:
        return _float_pieces(_FLOAT_BYTES[type(dt)], coder, c)
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return _text_pieces(part.width, coder == SORTABLE and part.width is None and not last, last, c)
    if isinstance(dt, T.BooleanType) and c.values is not None:
        return [_Piece(b"\1", None) if v else _point(b"\0", False) for v in set(c.values) if v is not None]
    return [_Piece(b"", None)]


# ---- whole keys ---------------------------------------------------------------------------------


def key_byte_ranges(
    parts: Sequence[KeyPart], coder: str, conditions: Mapping[int, KeyCondition], most: int = MOST_RANGES
) -> list[ByteRange]:
    """Sorted, separate byte ranges that hold every key whose parts meet ``conditions``, given by place of the part.

    None as an end is open. No range at all means that no key can meet them.
    """
    prefixes = [b""]
    for i, part in enumerate(parts):
        if i not in conditions:
            break
        pieces = _pieces(part, coder, i == len(parts) - 1, conditions[i])
        points = [p.point for p in pieces if p.point is not None]
        if len(points) == len(pieces) and i < len(parts) - 1 and len(prefixes) * len(points) <= most:
            prefixes = [p + point for p in prefixes for point in points]
            continue
        return _widened(
            [(p + x.start, prefix_end(p) if x.end is None else p + x.end) for p in prefixes for x in pieces], most
        )
    return _widened([(p, prefix_end(p)) for p in prefixes], most)


def _widened(ranges: list[ByteRange], most: int) -> list[ByteRange]:
    merged: list[ByteRange] = []
    for start, end in sorted(ranges, key=lambda r: r[0]):
        if merged and (merged[-1][1] is None or start <= merged[-1][1]):
            last = merged[-1][1]
            merged[-1] = (merged[-1][0], None if last is None or end is None else max(last, end))
        else:
            merged.append((start, end))
    step = -(-len(merged) // most) if merged else 1
    return [(run[0][0], run[-1][1]) for run in (merged[k : k + step] for k in range(0, len(merged), step))]


def in_byte_ranges(column: str, ranges: Sequence[ByteRange]) -> Column:
    """Rows whose binary ``column`` lies in one of the ranges; all bounds are literals and reach the scan."""
    key, terms = F.col(column), []
    for start, end in ranges:
        term = F.lit(True) if not start else key >= F.lit(bytearray(start))
        if end is not None:
            below = key < F.lit(bytearray(end))
            term = below if not start else term & below
        terms.append(term)
    while len(terms) > 1:  # in halves, so that many ranges don't make a deep expression
        pairs = zip(terms[::2], terms[1::2], strict=False)
        terms = [a | b for a, b in pairs] + terms[len(terms) // 2 * 2 :]
    return terms[0] if terms else F.lit(False)
