"""Typed reads: from cells to rows, maps and versions.

Two shapes are offered for families whose columns are not known up front:

* *entries*, one row per (key, qualifier[, ts]): the form to compute with, of any size;
* *maps*, one row per key, as a data source would present it.

A map is built in one task. Where keys may have more entries than a task should hold, the caller says over
how many ``parts`` every key is dealt: its maps are then disjoint, numbered by ``part``, and together
hold every entry. Nothing depends on how many entries a key has. ``decode`` is applied to the stored
values before they go into the map.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.catalog import Catalog
from cellrecon.catalog import Column as CatalogColumn
from cellrecon.functions.codecs import NATIVE, SORTABLE, KeyPart, decode_composite_key
from cellrecon.operators.key_conditions import KeyCondition, in_byte_ranges, key_byte_ranges
from cellrecon.operators.scans import (
    distinct_versions,
    latest_cells,
    newest_versions,
    project_columns,
    project_families,
    select_time,
)
from cellrecon.options import ReadOptions, Restrictive
from cellrecon.sources.cells import CELL

# Up to here every column is its own conditional aggregate; wider tables go through one map.
_MAX_CONDITIONAL = 48

ColumnNames = Mapping[str, tuple[str, str]]
Decode = Callable[[Column], Column]


def _is_cell(family: str, qualifier: str) -> Column:
    return (F.col("family") == family) & (F.col("qualifier") == qualifier)


def _order(cells: DataFrame) -> Column:
    return F.struct("ts", "seq" if "seq" in cells.columns else "value")


# ---- declared columns ---------------------------------------------------------------------------


def read_latest_wide(
    cells: DataFrame, columns: ColumnNames, restrictive: Restrictive = Restrictive.COLUMN
) -> DataFrame:
    """One row per key with the newest value of each declared column, null where there is none.

    ``columns`` maps output names to ``(family, qualifier)``. A single shuffle by key does it all,
    and every map task sends at most one row per key.
    """
    if len(columns) > _MAX_CONDITIONAL:
        return _latest_wide_by_map(cells, columns, restrictive)
    cells = restrict(cells, columns.values(), restrictive)
    order = _order(cells)
    return cells.groupBy("row_key").agg(
        *[
            F.max_by(F.col("value"), F.when(_is_cell(family, qualifier), order)).alias(name)
            for name, (family, qualifier) in columns.items()
        ]
    )


def _latest_wide_by_map(cells: DataFrame, columns: ColumnNames, restrictive: Restrictive) -> DataFrame:
    """The same rows for very wide catalogs, where a conditional aggregate per column would be too many.

    The catalog bounds both the broadcast list of columns and the size of a row's map. Which cells are declared
    is told by a join with that list, and columns are named in SQL: thousands of them are planned in a second or two.
    """
    if restrictive is Restrictive.FAMILY:
        cells = project_families(cells, dict.fromkeys(f for f, _ in columns.values()))
    kept = "inner" if restrictive is Restrictive.COLUMN else "left"
    slots = {cell: i for i, cell in enumerate(dict.fromkeys(columns.values()))}
    declared = cells.sparkSession.createDataFrame(
        [(f, q, i) for (f, q), i in slots.items()], "family string, qualifier string, _slot int"
    )
    entry = F.when(F.col("_slot").isNotNull(), F.struct("_slot", "value"))
    rows = (
        latest_cells(cells)
        .join(F.broadcast(declared), ["family", "qualifier"], kept)
        .groupBy("row_key")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("_values"))
    )
    return rows.selectExpr("row_key", *[f"_values[{slots[cell]}]" for cell in columns.values()]).toDF("row_key", *columns)


def read_version_rows(cells: DataFrame, columns: ColumnNames) -> DataFrame:
    """One row per key and distinct ``ts``, columns without a value at that ``ts`` being null.

    The version time is not part of the row, so equal versions of a key are one row.
    """
    cells = restrict(cells, columns.values(), Restrictive.COLUMN)
    order = F.col("seq" if "seq" in cells.columns else "value")
    versions = cells.groupBy("row_key", "ts").agg(
        *[
            F.max_by(F.col("value"), F.when(_is_cell(family, qualifier), order)).alias(name)
            for name, (family, qualifier) in columns.items()
        ]
    )
    return versions.drop("ts").distinct()


def restrict(
    cells: DataFrame, columns: Iterable[tuple[str, str]], restrictive: Restrictive
) -> DataFrame:
    columns = list(columns)
    if not columns or restrictive is Restrictive.NONE:
        return cells
    if restrictive is Restrictive.FAMILY:
        return project_families(cells, dict.fromkeys(f for f, _ in columns))
    return project_columns(cells, columns)


# ---- entries ------------------------------------------------------------------------------------


def _versions(cells: DataFrame, max_versions: int | None) -> DataFrame:
    return distinct_versions(cells) if max_versions is None else newest_versions(cells, max_versions)


def version_entries(
    cells: DataFrame, family: str, qualifier: str, max_versions: int | None = None
) -> DataFrame:
    """``row_key, ts, value`` of all selected versions of one column."""
    column = project_columns(cells, [(family, qualifier)])
    return _versions(column, max_versions).select("row_key", "ts", "value")


def _undeclared(cells: DataFrame, family: str, declared: Sequence[str]) -> DataFrame:
    cells = project_families(cells, [family])
    return cells.filter(~F.col("qualifier").isin(list(declared))) if declared else cells


def family_entries(cells: DataFrame, family: str, declared: Sequence[str] = ()) -> DataFrame:
    """``row_key, qualifier, value``: the newest value of every column of a family.

    Qualifiers that the catalog declares as columns of their own are left out.
    """
    return latest_cells(_undeclared(cells, family, declared)).select(
        "row_key", "qualifier", "value"
    )


def family_version_entries(
    cells: DataFrame,
    family: str,
    declared: Sequence[str] = (),
    max_versions: int | None = None,
) -> DataFrame:
    """``row_key, qualifier, ts, value``: the selected versions of every column of a family."""
    cells = _undeclared(cells, family, declared)
    return _versions(cells, max_versions).select("row_key", "qualifier", "ts", "value")


def regex_entries(cells: DataFrame, family: str, pattern: str) -> DataFrame:
    """``row_key, name, value`` of the columns whose whole qualifier matches ``pattern``.

    ``name`` is the pattern's group, empty if it has none. When several qualifiers of a key share a
    name, the last one in qualifier order holds.
    """
    groups = re.compile(pattern).groups
    if groups > 1:
        raise ValueError("a qualifier pattern has at most one group")
    whole = f"^(?:{pattern})$"
    matching = project_families(cells, [family]).filter(F.col("qualifier").rlike(whole))
    name = F.regexp_extract("qualifier", whole, 1) if groups else F.lit("")
    return (
        latest_cells(matching)
        .withColumn("name", name)
        .groupBy("row_key", "name")
        .agg(F.max_by("value", "qualifier").alias("value"))
    )


# ---- maps ---------------------------------------------------------------------------------------


def entries_to_maps(entries: DataFrame, key: str, value: str, parts: int = 1) -> DataFrame:
    """``row_key, part, data``: entries gathered into maps, those of every key dealt over ``parts`` rows."""
    _check_parts(parts)
    data = _map_of(key, value).alias("data")
    if parts == 1:
        # Grouped by key alone, so that joins by key find the maps in place.
        return entries.groupBy("row_key").agg(data).select("row_key", F.lit(0).alias("part"), "data")
    return entries.withColumn("part", _part(parts, key)).groupBy("row_key", "part").agg(data)


def _check_parts(parts: int) -> None:
    if parts < 1:
        raise ValueError("a map has at least one part")


def _part(parts: int, *by: str) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")


def _decoded(entries: DataFrame, decode: Decode | None) -> DataFrame:
    return entries if decode is None else entries.withColumn("value", decode(F.col("value")))


def _map_of(key: str, value: str) -> Column:
    return F.map_from_entries(F.collect_list(F.struct(key, value)))


def read_version_map(
    cells: DataFrame,
    family: str,
    qualifier: str,
    max_versions: int | None = None,
    decode: Decode | None = None,
    parts: int = 1,
) -> DataFrame:
    """``row_key, part, data map<bigint,T>``: the versions of one column by ``ts``."""
    entries = version_entries(cells, family, qualifier, max_versions)
    return entries_to_maps(_decoded(entries, decode), "ts", "value", parts)


def read_dynamic_family(
    cells: DataFrame,
    family: str,
    declared: Sequence[str] = (),
    decode: Decode | None = None,
    parts: int = 1,
) -> DataFrame:
    """``row_key, part, data map<string,T>``: newest values of a family by qualifier."""
    entries = family_entries(cells, family, declared)
    return entries_to_maps(_decoded(entries, decode), "qualifier", "value", parts)


def read_dynamic_versions(
    cells: DataFrame,
    family: str,
    declared: Sequence[str] = (),
    max_versions: int | None = None,
    decode: Decode | None = None,
    parts: int = 1,
) -> DataFrame:
    """``row_key, part, data map<string,map<bigint,T>>``: versions of a family by qualifier.

    Versions are dealt over the parts, so one qualifier may be in the maps of several of them.
    """
    _check_parts(parts)
    entries = _decoded(family_version_entries(cells, family, declared, max_versions), decode)
    dealt = entries.withColumn("part", F.lit(0) if parts == 1 else _part(parts, "qualifier", "ts"))
    keys = ["row_key"] if parts == 1 else ["row_key", "part"]
    # Both levels find their rows where one shuffle by key and part has put them.
    versions = dealt.repartition(*keys).groupBy(*keys, "qualifier").agg(_map_of("ts", "value").alias("versions"))
    maps = versions.groupBy(*keys).agg(_map_of("qualifier", "versions").alias("data"))
    return maps.select("row_key", F.lit(0).alias("part") if parts == 1 else "part", "data")


def read_qualifier_regex(cells: DataFrame, family: str, pattern: str, parts: int = 1) -> DataFrame:
    """``row_key, part, data map<string,T>`` of the columns that match a pattern, by the pattern's group."""
    return entries_to_maps(regex_entries(cells, family, pattern), "name", "value", parts)


def read_qualifier_scalar(cells: DataFrame, family: str, pattern: str, decode: Decode | None = None) -> DataFrame:
    """``row_key, qualifier, value``: for a pattern without group, the last column in qualifier order that matches.

    One value for each key that has such a column, with the newest version's time not considered between columns.
    """
    if re.compile(pattern).groups:
        raise ValueError("a pattern with a group gives a map, see read_qualifier_regex")
    matching = project_families(cells, [family]).filter(F.col("qualifier").rlike(f"^(?:{pattern})$"))
    last = F.struct("qualifier", "ts", "seq" if "seq" in cells.columns else "value")
    found = matching.groupBy("row_key").agg(
        F.max("qualifier").alias("qualifier"), F.max_by(F.col("value"), last).alias("value")
    )
    return _decoded(found, decode)


# ---- whole tables -------------------------------------------------------------------------------


def value_decoder(catalog: Catalog, schema: T.StructType, column: str | None = "value"):
    """How a stored value becomes a typed one: decoded from binary cells, cast from plain ones.

    ``column`` is one that holds stored values, all of which have its type.
    """
    binary = column is not None and schema[column].dataType == T.BinaryType()

    def decode(value: Column, column: CatalogColumn) -> Column:
        if binary or catalog.codec(column.coder).records:
            return catalog.codec(column.coder).decode(value, column.cell_type)
        return value.cast(column.cell_type)

    return decode


def key_columns(catalog: Catalog, cells: DataFrame) -> list[Column]:
    key, binary = F.col("row_key"), cells.schema["row_key"].dataType == T.BinaryType()
    if catalog.is_composite:
        parts = [KeyPart(c.data_type, c.length) for c in catalog.key]
        decoded = decode_composite_key(key, parts, catalog.table_coder)
    elif binary:
        only = catalog.key[0]
        decoded = [catalog.codec(only.coder).decode(key, only.data_type)]
    else:
        decoded = [key.cast(catalog.key[0].data_type)]
    return [d.alias(c.name) for d, c in zip(decoded, catalog.key, strict=True)]


def _is_map(column: CatalogColumn) -> bool:
    return column.is_dynamic or column.is_version_map


def _declared(catalog: Catalog, family: str) -> list[str]:
    return [c.qualifier for c in catalog.value_columns if c.family == family and c.qualifier]


def _typed_keys(catalog: Catalog, conditions: Sequence[KeyCondition]) -> dict[int, list[KeyCondition]]:
    """The conditions on each key part, by its place in the key."""
    places = {c.name: i for i, c in enumerate(catalog.key)}
    found: dict[int, list[KeyCondition]] = {}
    for condition in conditions:
        if condition.column not in places:
            raise ValueError(f"{condition.column!r} is no part of the row key")
        found.setdefault(places[condition.column], []).append(condition)
    return found


def narrow_to_keys(cells: DataFrame, catalog: Catalog, conditions: Sequence[KeyCondition]) -> DataFrame:
    """Cells that may belong to keys which meet all ``conditions``: bounds on the stored key that reach the scan.

    Encoded keys are compared as bytes, see :mod:`cellrecon.operators.key_conditions`. They may let
    further keys through; the conditions on the typed key parts still have to be applied. Keys of user-made
    codecs narrow nothing.
    """
    found = _typed_keys(catalog, conditions)
    key_type = cells.schema["row_key"].dataType
    if key_type != T.BinaryType():
        if not catalog.is_composite and key_type == catalog.key[0].data_type:
            for condition in found.get(0, []):
                cells = cells.filter(condition.of(F.col("row_key")))
        return cells
    coder = catalog.table_coder if catalog.is_composite else catalog.key[0].coder
    if coder not in (NATIVE, SORTABLE):
        return cells
    parts = [KeyPart(c.data_type, c.length) for c in catalog.key]
    rounds = max(map(len, found.values()), default=0)
    for k in range(rounds):  # a second condition on a part meets the first above the scan
        chosen = {i: c[min(k, len(c) - 1)] for i, c in found.items()}
        cells = cells.filter(in_byte_ranges("row_key", key_byte_ranges(parts, coder, chosen)))
    return cells


def read_table(
    cells: DataFrame,
    catalog: Catalog,
    options: ReadOptions = ReadOptions(),
    columns: Sequence[str] | None = None,
    key_conditions: Sequence[KeyCondition] = (),
    parts: int = 1,
    merge_first: bool = True,
) -> DataFrame:
    """The table a catalog describes, as typed rows.

    ``columns`` asks for some columns only, in that order; with ``Restrictive.COLUMN`` a key gives a
    row only if it has a cell in one of them. Filters on plain key columns placed on the result are moved
    below the aggregation by Spark; an encoded key is opaque to it, so conditions on its parts are given as
    ``key_conditions`` and reach the scan as byte ranges. Filters on values are applied to the newest value, as
    they must be.

    Map columns are read in one scan with the scalar ones. With ``parts`` above 1 each key's maps are dealt over
    that many rows, told apart by a column ``part``; the scalar columns are the same in all of them.
    ``merge_first`` merges versions in the map tasks before cells move to their keys, which
    takes a second exchange of what is left; without it all selected cells move once.
    """
    _check_parts(parts)
    wanted = catalog.select(list(columns) if columns is not None else None)
    values = [c for c in wanted if not c.is_key]
    scalars, maps = [c for c in values if not _is_map(c)], [c for c in values if _is_map(c)]
    cells = narrow_to_keys(select_time(cells, options), catalog, key_conditions)
    decode = value_decoder(catalog, cells.schema)
    slots = {c.name: f"_c{i}" for i, c in enumerate(values)}
    names = {slots[c.name]: (c.family, c.qualifier) for c in scalars}

    if not options.merge_to_latest:
        if maps:
            raise ValueError("map columns cannot be read as version rows")
        if options.max_versions is not None and names:
            cells = newest_versions(project_columns(cells, names.values()), options.max_versions)
        rows = read_version_rows(cells, names) if names else cells.select("row_key").distinct()
    elif not maps:
        rows = _scalar_rows(cells, names, options.restrictive)
    else:
        rows = _shaped_rows(cells, catalog, options, slots, scalars, maps, decode, parts, merge_first)

    key = dict(zip((c.name for c in catalog.key), key_columns(catalog, cells), strict=True))
    for condition in key_conditions:
        rows = rows.filter(condition.of(key[condition.column]))
    out = {n: k.alias(n) for n, k in key.items()}
    out.update({c.name: decode(F.col(slots[c.name]), c).alias(c.name) for c in scalars})
    out.update({c.name: F.col(slots[c.name]).alias(c.name) for c in maps})
    extra = ["part"] if maps and parts > 1 else []
    return rows.select(*[out[c.name] for c in wanted], *extra)


def _shaped_rows(
    cells: DataFrame,
    catalog: Catalog,
    options: ReadOptions,
    slots: Mapping[str, str],
    scalars: Sequence[CatalogColumn],
    maps: Sequence[CatalogColumn],
    decode,
    parts: int,
    merge_first: bool,
) -> DataFrame:
    """``row_key, part`` and a column for each slot, scalars and maps of all shapes from one scan.

    Every cell is tagged with the slots it belongs to and with what tells entries of a slot apart: the
    qualifier, the version's time, both or nothing. Newest values are taken by these, and entries are then
    gathered by key and part.
    """
    limit = options.max_versions

    def deep(c: CatalogColumn) -> bool:
        """Whether entries are told apart by time: every version is one, unless only the newest is wanted."""
        return (c.is_version_map or c.is_dynamic_versions) and limit != 1

    tags, wanted = [], F.lit(False)
    no_name, no_time = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for c in [*scalars, *maps]:
        belongs = F.col("family") == c.family
        if c.is_dynamic:
            declared = _declared(catalog, c.family)
            belongs = belongs & ~F.col("qualifier").isin(declared) if declared else belongs
        else:
            belongs = belongs & (F.col("qualifier") == c.qualifier)
        wanted = wanted | belongs
        name, at = F.col("qualifier") if c.is_dynamic else no_name, F.col("ts") if deep(c) else no_time
        # Entries of one cell are ranked together where versions are limited, so these keep to one part.
        dealt = [c for c, used in (("qualifier", c.is_dynamic), ("ts", deep(c) and limit is None)) if used]
        where = F.array(_part(parts, *dealt)) if dealt and parts > 1 else _all_parts(parts if c in scalars else 1)
        tags.append(F.when(belongs, _tags(slots[c.name], name, at, where)))
    if options.restrictive is not Restrictive.COLUMN:
        present = F.lit(True)
        if options.restrictive is Restrictive.FAMILY:
            present = F.col("family").isin(sorted({c.family for c in [*scalars, *maps]}))
        wanted = wanted | present
        tags.append(F.when(present, _tags("", no_name, no_time, _all_parts(parts))))
    tagged = cells.filter(wanted).select(
        "*", F.explode(F.flatten(F.array_compact(F.array(*tags)))).alias("_tag")
    ).select("row_key", "ts", *(["seq"] if "seq" in cells.columns else []), "value", "_tag.*")

    by = ["row_key", "part"]
    if not merge_first:
        tagged = tagged.repartition(*by)
    entries = tagged.groupBy(*by, "slot", "name", "at").agg(
        F.max("ts").alias("ts"), F.max_by(F.col("value"), _order(cells)).alias("value")
    )
    if merge_first:
        entries = entries.repartition(*by)
    if limit is not None and limit > 1 and any(deep(c) for c in maps):
        newest = Window.partitionBy(*by, "slot", "name").orderBy(F.desc("at"))
        entries = entries.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= limit).drop("_rank")
    # Decoded here, one column for each map: what follows only gathers.
    typed = {c: f"_v{slots[c.name]}" for c in maps}
    entries = entries.withColumns(
        {v: decode(F.when(F.col("slot") == slots[c.name], F.col("value")), c) for c, v in typed.items()}
    )
    nested = [c for c in maps if c.is_dynamic_versions]
    if nested:
        # Versions of a qualifier become one map; entries of other slots are groups of their own.
        inside = F.col("slot").isin([slots[c.name] for c in nested])
        version = F.coalesce("at", "ts")
        entries = entries.groupBy(*by, "slot", "name", F.when(~inside, F.col("at")).alias("at")).agg(
            F.max("ts").alias("ts"),
            F.first("value").alias("value"),
            *[F.first(v).alias(v) for c, v in typed.items() if c not in nested],
            *[
                F.map_from_entries(
                    F.collect_list(F.when(F.col("slot") == slots[c.name], F.struct(version, F.col(typed[c]))))
                ).alias(typed[c])
                for c in nested
            ],
        )
    gathered = []
    for c in scalars:
        here = F.col("slot") == slots[c.name]
        gathered.append(F.max_by(F.col("value"), F.when(here, F.col("ts"))).alias(slots[c.name]))
    for c in maps:
        key = F.coalesce("at", "ts") if c.is_version_map else F.col("name")
        entry = F.when(F.col("slot") == slots[c.name], F.struct(key, F.col(typed[c])))
        gathered.append(F.collect_list(entry).alias(slots[c.name]))
    rows = entries.groupBy(*by).agg(*gathered)
    found = {slots[c.name]: F.col(slots[c.name]) for c in maps}
    return rows.withColumns({n: F.when(F.size(f) > 0, F.map_from_entries(f)) for n, f in found.items()})


def _tags(slot: str, name: Column, at: Column, parts: Column) -> Column:
    """A tag for each of the parts that a cell goes to."""

    def tag(part: Column) -> Column:
        return F.struct(F.lit(slot).alias("slot"), name.alias("name"), at.alias("at"), part.alias("part"))

    return F.transform(parts, tag)


def _all_parts(parts: int) -> Column:
    return F.array(*[F.lit(p) for p in range(parts)])


def _scalar_rows(cells: DataFrame, names: ColumnNames, restrictive: Restrictive) -> DataFrame:
    if not names:
        return cells.select("row_key").distinct()
    return read_latest_wide(cells, names, restrictive)


def cells_per_row(cells: DataFrame) -> DataFrame:
    """``row_key, count``: how many columns each key has.

    Versions of a column are merged first, in the map tasks; a key with very many columns is then
    counted in partial sums.
    """
    columns = cells.select(*CELL).distinct()
    return columns.groupBy("row_key").agg(F.count(F.lit(1)).alias("count"))
