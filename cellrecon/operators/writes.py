"""From rows to cells, and storing them.

Writing never deletes: new cells add versions, and a value written to the same cell at the same
``ts`` replaces the earlier one when read, by its higher ``seq``. Appending Parquet files is
therefore all a write does; :func:`upsert_cells` shows the merged state and
:func:`cellrecon.operators.scans.distinct_versions` compacts it.

``ts`` is required: an epoch millisecond number or a column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.catalog import Catalog
from cellrecon.functions.codecs import KeyPart, encode_composite_key
from cellrecon.operators.ranges import partition_of
from cellrecon.operators.scans import distinct_versions
from cellrecon.sources.cells import CELL


class PartitionCountError(ValueError):
    """A new table needs more than three key-range partitions."""


def _column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("bigint")


def _stamps(ts: Column | int | None, seq: Column | int | None) -> list[Column]:
    """The columns that place a write in time."""
    named = {"ts": ts, "seq": seq}
    return [_column(c).alias(name) for name, c in named.items() if c is not None]


def _layout(cells: DataFrame) -> DataFrame:
    """Drop absent values and put the columns in cell order."""
    order = [*CELL, "ts", *(["seq"] if "seq" in cells.columns else []), "value"]
    return cells.filter(F.col("value").isNotNull()).select(*order)


def write_cells(
    rows: DataFrame,
    key: str,
    columns: Mapping[str, tuple[str, str]],
    ts: Column | int,
    seq: Column | int | None = None,
) -> DataFrame:
    """One cell per row and non-null column; nulls write nothing.

    ``columns`` maps column names to ``(family, qualifier)``. The columns need one common type.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(family).alias("family"),
                F.lit(qualifier).alias("qualifier"),
                F.col(name).alias("value"),
            )
            for name, (family, qualifier) in columns.items()
        ]
    )
    return _layout(rows.select(F.col(key).alias("row_key"), *_stamps(ts, seq), F.inline(cells)))


def write_dynamic_family(
    rows: DataFrame,
    key: str,
    data: str,
    family: str,
    ts: Column | int,
    seq: Column | int | None = None,
) -> DataFrame:
    """One cell per entry of a ``map<string,T>`` column, the entry's key naming the qualifier."""
    cells = rows.select(
        F.col(key).alias("row_key"),
        F.lit(family).alias("family"),
        *_stamps(ts, seq),
        F.explode(data).alias("qualifier", "value"),
    )
    return _layout(cells)


def write_version_map(
    rows: DataFrame,
    key: str,
    data: str,
    family: str,
    qualifier: str,
    seq: Column | int | None = None,
) -> DataFrame:
    """One cell version per entry of a ``map<bigint,T>`` column, written at the entry's key."""
    cells = rows.select(
        F.col(key).alias("row_key"),
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        *_stamps(None, seq),
        F.explode(data).alias("ts", "value"),
    )
    return _layout(cells)


def write_dynamic_versions(
    rows: DataFrame, key: str, data: str, family: str, seq: Column | int | None = None
) -> DataFrame:
    """One cell version per inner entry of a ``map<string,map<bigint,T>>`` column."""
    columns = rows.select(
        F.col(key).alias("row_key"),
        F.lit(family).alias("family"),
        *_stamps(None, seq),
        F.explode(data).alias("qualifier", "_versions"),
    )
    kept = [c for c in columns.columns if c != "_versions"]
    return _layout(columns.select(*kept, F.explode("_versions").alias("ts", "value")))


def write_table(
    rows: DataFrame, catalog: Catalog, ts: Column | int, seq: Column | int | None = None
) -> DataFrame:
    """The binary cells of a typed table, keys and values encoded by the catalog's coders."""
    names = [c.name for c in catalog.key]
    encoded_key = (
        encode_composite_key(
            [F.col(n) for n in names],
            [KeyPart(c.data_type, c.length) for c in catalog.key],
            catalog.table_coder,
        )
        if catalog.is_composite
        else catalog.codec(catalog.key[0].coder).encode(F.col(names[0]), catalog.key[0].data_type)
    )
    no_key = F.raise_error(F.lit("a row has no key")).cast("binary")
    keyed = rows.withColumns({"_row_key": F.coalesce(encoded_key, no_key), "_ts": _column(ts)})
    if seq is not None:
        keyed = keyed.withColumn("_seq", _column(seq))
    place = (F.col("_ts"), None if seq is None else F.col("_seq"))

    def encode(value: Column, column) -> Column:
        return catalog.codec(column.coder).encode(value, column.cell_type)

    present = [c for c in catalog.value_columns if c.name in rows.columns]
    scalars = [c for c in present if not (c.is_dynamic or c.is_version_map)]
    frames = []
    if scalars:
        narrow = keyed.select(
            "_row_key",
            "_ts",
            *(["_seq"] if seq is not None else []),
            *[encode(F.col(c.name), c).alias(c.name) for c in scalars],
        )
        targets = {c.name: (c.family, c.qualifier) for c in scalars}
        frames.append(write_cells(narrow, "_row_key", targets, *place))
    for c in present:
        if c.is_dynamic_versions:
            cells = write_dynamic_versions(keyed, "_row_key", c.name, c.family, place[1])
        elif c.is_dynamic:
            cells = write_dynamic_family(keyed, "_row_key", c.name, c.family, *place)
        elif c.is_version_map:
            cells = write_version_map(keyed, "_row_key", c.name, c.family, c.qualifier, place[1])
        else:
            continue
        frames.append(cells.withColumn("value", encode(F.col("value"), c)))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def write_at_timestamp(cells: DataFrame, ts: int) -> DataFrame:
    """The same cells, all written at ``ts``."""
    return cells.withColumn("ts", _column(ts))


def upsert_cells(stored: DataFrame, written: DataFrame) -> DataFrame:
    """The table after a write: every version once, the later write holding where both have it.

    Both sides carry ``seq``; the write's must be higher where it is to replace stored values.
    """
    return distinct_versions(stored.unionByName(written))


def append_cells(cells: DataFrame, path: str) -> None:
    """Add cells to the table stored at ``path``."""
    cells.write.mode("append").parquet(path)


# ---- key-range layout ---------------------------------------------------------------------------

# The first and last split points of a new table.
FIRST_SPLIT, LAST_SPLIT = b"aaaaaaa", b"zzzzzzz"


def presplit_points(partitions: int) -> list[bytes]:
    """Split points of a new table with ``partitions`` key ranges, evenly spaced as numbers."""
    if partitions <= 3:
        raise PartitionCountError("a new table needs more than three key-range partitions")
    low, high = int.from_bytes(FIRST_SPLIT), int.from_bytes(LAST_SPLIT)
    step = (high - low) // (partitions - 2)
    inner = [low + step * i for i in range(1, partitions - 2)]
    return [FIRST_SPLIT, *[n.to_bytes(len(FIRST_SPLIT)) for n in inner], LAST_SPLIT]


def assign_presplit(cells: DataFrame, partitions: int) -> DataFrame:
    """Add ``partition``: which of the evenly split key ranges a text or binary key falls into."""
    key = F.col("row_key").cast("binary")
    splits = [bytearray(p) for p in presplit_points(partitions)]
    return cells.withColumn("partition", partition_of(key, splits))


#: The column, and so the folder, that tells which declared range a stored file belongs to.
KEY_RANGE = "key_range"


def write_presplit(
    cells: DataFrame, path: str, partitions: int, points: Sequence | None = None, files: int | None = None
) -> None:
    """Create a table of sorted files, each within one of the declared key ranges.

    The ranges lie between ``points``, ascending bounds of the key's type, or are the evenly split ones of
    text and binary keys (:func:`presplit_points`); other keys have one range where no points are given. Within them rows are cut into about ``files`` (by default
    ``partitions``) sampled stretches of the full cell order: a range with much of the table, even one key, is
    spread over several files, a file never holds cells of two ranges, and an empty range has none. Files lie in a folder for
    each range, which reads can be limited to; sorted files let key filters skip row groups.
    """
    if partitions <= 3:
        raise PartitionCountError("a new table needs more than three key-range partitions")
    if points is None and not isinstance(cells.schema["row_key"].dataType, (T.StringType, T.BinaryType)):
        assigned = cells.withColumn(KEY_RANGE, F.lit(0))
    elif points is None:
        assigned = assign_presplit(cells, partitions).withColumnRenamed("partition", KEY_RANGE)
    else:
        if len(points) != partitions - 1:
            raise ValueError(f"{partitions} key ranges have {partitions - 1} bounds between them")
        assigned = cells.withColumn(KEY_RANGE, partition_of(F.col("row_key"), list(points)))
    order = [KEY_RANGE, *CELL, "ts"]
    ordered = assigned.repartitionByRange(files or partitions, *order).sortWithinPartitions(*order)
    ordered.write.mode("errorifexists").partitionBy(KEY_RANGE).options(**key_bloom_options()).parquet(path)


def key_bloom_options(distinct_keys: int = 1_000_000) -> dict[str, str]:
    """Options of a Parquet write that give each row group a Bloom filter on its keys.

    ``distinct_keys`` is how many a row group is expected to have; its filter takes some ten bits for each.
    """
    return {
        "parquet.bloom.filter.enabled#row_key": "true",
        "parquet.bloom.filter.expected.ndv#row_key": str(distinct_keys),
        "parquet.bloom.filter.adaptive.enabled": "true",
    }


def write_sorted(cells: DataFrame, path: str, files: int) -> None:
    """Create a table of about ``files`` sorted files, cut by sampled keys, with Bloom filters on them."""
    order = [*CELL, "ts"]
    ordered = cells.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ordered.write.mode("errorifexists").options(**key_bloom_options()).parquet(path)
