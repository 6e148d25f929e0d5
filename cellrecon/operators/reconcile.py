"""Reconciliation: where two copies of a table differ.

Keys are unique and never null in a keyed table, and so in everything the typed reads return; the
joins rely on that. ``check_keys=True`` verifies it for tables from elsewhere. A diff of two reads of
tables with plain keys shuffles nothing again, as reads that group by key leave their rows where the join
needs them. Of cell tables, plain or encoded, both sides can be aggregated together in one shuffle instead, and
compared as they are stored (``diff_family``, ``diff_encoded_tables`` and the functions beside them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrecon.catalog import Catalog
from cellrecon.operators.reads import key_columns, read_latest_wide, restrict, value_decoder
from cellrecon.operators.scans import select_time
from cellrecon.options import ReadOptions
from cellrecon.session import written
from cellrecon.sources.cells import CELL

# The texts and the name of the Diff column, and the names of a document's two maps
# (Table_Cluster1, Table_Cluster2).
ONLY_IN_1 = "New row in DataFrame 1"
ONLY_IN_2 = "New row in DataFrame 2"
DIFF = "Diff"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _side(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"table {n} has no column {missing}")
    return df.select(*[F.col(c).alias(f"_{n}_{c}") for c in columns])


def _on(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"_1_{k}") == F.col(f"_2_{k}"))
    return condition


def join_sides(df1: DataFrame, df2: DataFrame, key: str | Sequence[str], how: str) -> DataFrame:
    """Join two copies of a table, their columns named ``_1_<name>`` and ``_2_<name>``."""
    columns, keys = df1.columns, _keys(key)
    return _side(df1, columns, 1).join(_side(df2, columns, 2), _on(keys), how)


def _present(n: int, keys: Sequence[str]) -> Column:
    return F.col(f"_{n}_{keys[0]}").isNotNull()


def _differs(column: str, null_safe: bool) -> Column:
    a, b = F.col(f"_1_{column}"), F.col(f"_2_{column}")
    return ~a.eqNullSafe(b) if null_safe else a != b


def pick_present_side(joined: DataFrame, keys: str | Sequence[str], columns: Sequence[str]) -> list[Column]:
    """Per column the first side's value if that side has the key, else the second's.

    ``joined`` holds both sides' columns as ``_1_<name>`` and ``_2_<name>``.
    """
    in_1 = _present(1, _keys(keys))
    return [
        F.when(in_1, joined[f"_1_{c}"]).otherwise(joined[f"_2_{c}"]).alias(c) for c in columns
    ]


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that are null or occur more than once, with their number of rows."""
    keys = _keys(key)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter((F.col("rows") > 1) | null_key)


def require_unique_keys(df: DataFrame, key: str | Sequence[str]) -> None:
    bad = duplicate_keys(df, key).limit(3).collect()
    if bad:
        raise ValueError(f"keys that are null or not unique, for instance {bad}")


def diff_tables(
    df1: DataFrame,
    df2: DataFrame,
    key: str | Sequence[str],
    *,
    null_safe: bool = True,
    check_keys: bool = False,
) -> DataFrame:
    """Rows that differ between two tables: the first table's columns and ``Diff``.

    ``Diff`` tells which table alone has the key, or names the differing columns, each followed by a
    blank, in column order. Values are the first table's unless only the second has the key. With
    ``null_safe=False`` a null equals nothing and differs from nothing, so that a value missing on
    one side goes unreported.
    """
    keys = _keys(key)
    if check_keys:
        require_unique_keys(df1, keys)
        require_unique_keys(df2, keys)
    joined = join_sides(df1, df2, keys, "full_outer")
    diff = joined.select("*", diff_text(keys, df1.columns, null_safe).alias(DIFF))
    return diff.filter(F.col(DIFF) != "").select(*diff_row(diff, keys, df1.columns))


def diff_text(keys: Sequence[str], columns: Sequence[str], null_safe: bool = True) -> Column:
    """The ``Diff`` of two joined sides, empty where they agree."""
    names = F.concat_ws(
        "", *[F.when(_differs(c, null_safe), f"{c} ") for c in columns if c not in keys]
    )
    return (
        F.when(~_present(1, keys), ONLY_IN_2).when(~_present(2, keys), ONLY_IN_1).otherwise(names)
    )


def diff_row(joined: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> list[Column]:
    return [*pick_present_side(joined, keys, columns), F.col(DIFF)]


def diff_columns(df1: DataFrame, df2: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """For keys on both sides, one row per differing column: keys, ``column, value1, value2``.

    The wide rows are joined once and only the differences are unfolded; values are shown as text.
    """
    keys = _keys(key)
    joined = join_sides(df1, df2, keys, "inner")
    return joined.select(*differing_columns(keys, df1.columns))


def differing_columns(keys: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """Unfold two joined sides that both have the key: keys, ``column, value1, value2``."""
    pairs = [
        F.when(
            _differs(c, True),
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_1_{c}").cast("string").alias("value1"),
                F.col(f"_2_{c}").cast("string").alias("value2"),
            ),
        )
        for c in columns
        if c not in keys
    ]
    return [
        *[F.col(f"_1_{k}").alias(k) for k in keys],
        F.inline(F.array_compact(F.array(*pairs))),
    ]


def diff_cells(cells1: DataFrame, cells2: DataFrame) -> DataFrame:
    """Value-level diff of two sets of entries ``row_key, qualifier, value``.

    Gives ``row_key, qualifier, value1, value2, Diff`` for entries that are missing on one side or
    have another value; works for columns that no schema declares.
    """
    keys = ["row_key", "qualifier"]
    columns = [*keys, "value"]
    joined = join_sides(cells1.select(*columns), cells2.select(*columns), keys, "full_outer")
    diff = (
        F.when(~_present(1, keys), ONLY_IN_2)
        .when(~_present(2, keys), ONLY_IN_1)
        .when(_differs("value", True), "value ")
    )
    return joined.select(
        *[F.coalesce(f"_1_{k}", f"_2_{k}").alias(k) for k in keys],
        F.col("_1_value").alias("value1"),
        F.col("_2_value").alias("value2"),
        diff.alias(DIFF),
    ).filter(F.col(DIFF).isNotNull())


def diff_summary(df1: DataFrame, df2: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: ``rows1, rows2, only_in_1, only_in_2, changed, same``."""
    keys = _keys(key)
    joined = join_sides(df1, df2, keys, "full_outer")
    diff = joined.select("*", diff_text(keys, df1.columns).alias(DIFF))
    return diff.agg(*summary_counts(keys))


def summary_counts(keys: Sequence[str]) -> list[Column]:
    """The counts of :func:`diff_summary` over two joined sides with their ``Diff``."""
    in_1, in_2, differs = _present(1, keys), _present(2, keys), F.col(DIFF) != ""
    return [
        F.count_if(in_1).alias("rows1"),
        F.count_if(in_2).alias("rows2"),
        F.count_if(in_1 & ~in_2).alias("only_in_1"),
        F.count_if(in_2 & ~in_1).alias("only_in_2"),
        F.count_if(in_1 & in_2 & differs).alias("changed"),
        F.count_if(in_1 & in_2 & ~differs).alias("same"),
    ]


def compare_row_counts(df1: DataFrame, df2: DataFrame) -> DataFrame:
    """One row ``n1, n2, same``; only row counts travel."""
    sides = df1.select(F.lit(1).alias("side")).union(df2.select(F.lit(2).alias("side")))
    counts = sides.agg(
        F.count_if(F.col("side") == 1).alias("n1"), F.count_if(F.col("side") == 2).alias("n2")
    )
    return counts.withColumn("same", F.col("n1") == F.col("n2"))


def left_outer_pair(df1: DataFrame, df2: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Every row of the first table beside its counterpart, columns suffixed ``_1`` and ``_2``."""
    keys = _keys(key)
    joined = join_sides(df1, df2, keys, "left_outer")
    return joined.select(
        *[F.col(f"_{n}_{c}").alias(f"{c}_{n}") for n in (1, 2) for c in df1.columns]
    )


def column_except(df1: DataFrame, df2: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, value``: the distinct values of each column of table 1 that table 2 lacks.

    Both sides are unfolded and merged by value in one pass. Repeated values are merged before they
    travel, so a value that fills much of a column is no burden; nulls count as values.
    """
    columns = list(columns or df1.columns)

    def values(df: DataFrame, in_1: bool) -> DataFrame:
        texts = [F.col(c).cast("string").alias(c) for c in columns]
        return (
            df.select(*texts)
            .unpivot([], columns, "column", "value")
            .withColumn("in_1", F.lit(in_1))
        )

    both = values(df1, True).union(values(df2, False))
    return (
        both.groupBy("column", "value")
        .agg(F.bool_and("in_1").alias("only_in_1"))
        .filter("only_in_1")
        .select("column", "value")
    )


def rename_all(df: DataFrame, *names: str) -> DataFrame:
    """Rename all columns by position."""
    return df.toDF(*names)


def select_columns(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The wanted columns, key columns first."""
    return df.select(*[c for c in columns if c in keys], *[c for c in columns if c not in keys])


def preview_rows(df: DataFrame, key: str | Sequence[str], n: int = 10) -> DataFrame:
    """The first rows in key order; each task keeps its own first ``n`` only."""
    return df.orderBy(*_keys(key)).limit(n)


# ---- tables without a declared schema -----------------------------------------------------------


def count_mismatch_join(counts1: DataFrame, counts2: DataFrame) -> DataFrame:
    """Keys on both sides with different counts: ``rowkey1, count1, rowkey2, count2``."""
    pair = rename_all(counts1.select("row_key", "count"), "rowkey1", "count1").join(
        rename_all(counts2.select("row_key", "count"), "rowkey2", "count2"),
        (F.col("rowkey1") == F.col("rowkey2")) & (F.col("count1") != F.col("count2")),
    )
    return pair.select("rowkey1", "count1", "rowkey2", "count2")


def detail_lookup_join(mismatches: DataFrame, maps1: DataFrame, maps2: DataFrame) -> DataFrame:
    """``rowkey, part, Table_Cluster1, Table_Cluster2``: both sides' content of mismatched keys.

    The maps come from ``read_dynamic_family`` with the same number of parts, so that a qualifier is in the same
    part on both sides; a part that one side lacks has a null there.
    """
    keys = mismatches.select(F.col("rowkey1").alias("row_key"))
    # The semi-join moves below the aggregation that builds the maps.
    return _pair_maps(*[m.join(keys, "row_key", "left_semi") for m in (maps1, maps2)])


def _pair_maps(maps1: DataFrame, maps2: DataFrame) -> DataFrame:
    return (
        maps1.withColumnRenamed("data", "Table_Cluster1")
        .join(maps2.withColumnRenamed("data", "Table_Cluster2"), ["row_key", "part"], "full_outer")
        .withColumnRenamed("row_key", "rowkey")
    )


# ---- both sides in one aggregation --------------------------------------------------------------


def _tagged_union(cells1: DataFrame, cells2: DataFrame) -> DataFrame:
    """Cells of both sides with a column ``_side``."""
    sides = [c.withColumn("_side", F.lit(n)) for n, c in ((1, cells1), (2, cells2))]
    return sides[0].unionByName(sides[1])


def _newest(side: int, order: Column, condition: Column | None = None) -> Column:
    """The newest value among one side's cells."""
    here = F.col("_side") == side if condition is None else (F.col("_side") == side) & condition
    return F.max_by(F.col("value"), F.when(here, order))


def latest_of_sides(cells1: DataFrame, cells2: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, ``in_1, value1, in_2, value2``: the newest value of each group on either side.

    Both sides move together, once, after each map task has merged the versions and both sides of a
    group to one row; nothing is joined, and a key with most of the cells is no burden.
    """
    order = F.struct("ts", "seq" if "seq" in cells1.columns else "value")
    aggregates = [
        column
        for n in (1, 2)
        for column in (F.bool_or(F.col("_side") == n).alias(f"in_{n}"), _newest(n, order).alias(f"value{n}"))
    ]
    return _tagged_union(cells1, cells2).groupBy(*by).agg(*aggregates)


def _of_family(cells: DataFrame, family: str, declared: Sequence[str]) -> DataFrame:
    cells = cells.filter(F.col("family") == family)
    return cells.filter(~F.col("qualifier").isin(list(declared))) if declared else cells


def diff_family(cells1: DataFrame, cells2: DataFrame, family: str, declared: Sequence[str] = ()) -> DataFrame:
    """The rows of :func:`diff_cells` for the newest values of a family, from one aggregation of both sides."""
    pairs = latest_of_sides(*[_of_family(c, family, declared) for c in (cells1, cells2)], ["row_key", "qualifier"])
    diff = (
        F.when(~F.col("in_1"), ONLY_IN_2)
        .when(~F.col("in_2"), ONLY_IN_1)
        .when(~F.col("value1").eqNullSafe(F.col("value2")), "value ")
    )
    return pairs.select("row_key", "qualifier", "value1", "value2", diff.alias(DIFF)).filter(F.col(DIFF).isNotNull())


def count_mismatches(cells1: DataFrame, cells2: DataFrame) -> DataFrame:
    """The rows of :func:`count_mismatch_join` over both sides' columns per key, without joining the sides.

    A column is merged over both sides first and then counts for each side that has it, in partial sums.
    """
    columns = _tagged_union(*[c.select(*CELL) for c in (cells1, cells2)]).groupBy(*CELL).agg(
        *[F.bool_or(F.col("_side") == n).alias(f"in_{n}") for n in (1, 2)]
    )
    counts = columns.groupBy("row_key").agg(*[F.count_if(f"in_{n}").alias(f"count{n}") for n in (1, 2)])
    found = counts.filter("count1 > 0 AND count2 > 0 AND count1 <> count2")
    key = F.col("row_key")
    return found.select(key.alias("rowkey1"), "count1", key.alias("rowkey2"), "count2")


def diff_by_cell_count(cells1: DataFrame, cells2: DataFrame, family: str, parts: int = 1) -> DataFrame:
    """Keys on both sides whose number of columns in a family differs, with both contents as maps.

    ``rowkey, part, Table_Cluster1, Table_Cluster2``; every key is dealt over ``parts`` rows, both sides alike,
    so that a qualifier is in the same document. The mismatched keys are written out first. Usually they are few;
    Spark then broadcasts them and drops all other cells as it scans. Changed values under an equal count
    and keys on one side only are not reported here; :func:`diff_family` reports everything.
    """
    if parts < 1:
        raise ValueError("a document has at least one part")
    of_family = [_of_family(c, family, ()) for c in (cells1, cells2)]
    keys = written(count_mismatches(*of_family), "mismatches").select(F.col("rowkey1").alias("row_key"))
    narrow = [c.join(keys, "row_key", "left_semi") for c in of_family]
    pairs = latest_of_sides(*narrow, ["row_key", "qualifier"])
    part = F.pmod(F.xxhash64("qualifier"), F.lit(parts)).cast("int").alias("part")
    entries = [F.when(F.col(f"in_{n}"), F.struct("qualifier", f"value{n}")) for n in (1, 2)]
    gathered = pairs.groupBy(F.col("row_key").alias("rowkey"), part).agg(
        *[F.collect_list(e).alias(f"_{n}") for n, e in ((1, entries[0]), (2, entries[1]))]
    )
    maps = [F.when(F.size(f"_{n}") > 0, F.map_from_entries(f"_{n}")).alias(f"Table_Cluster{n}") for n in (1, 2)]
    return gathered.select("rowkey", "part", *maps)


# ---- declared columns, compared as they are stored ----------------------------------------------


def _stored_names(catalog: Catalog) -> dict[str, tuple[str, str]]:
    values = catalog.value_columns
    if any(c.is_dynamic or c.is_version_map for c in values):
        raise ValueError("map columns are compared by diff_family")
    return {c.name: (c.family, c.qualifier) for c in values}


def stored_pairs(
    cells1: DataFrame, cells2: DataFrame, catalog: Catalog, options: ReadOptions = ReadOptions()
) -> DataFrame:
    """Both sides' newest stored values by stored key: ``row_key, in_1, in_2``, ``_1_<name>``, ``_2_<name>``.

    One aggregation of both sides, see :func:`latest_of_sides`; keys and values are the stored ones, nothing is decoded.
    """
    names = _stored_names(catalog)
    narrow = [restrict(select_time(c, options), names.values(), options.restrictive) for c in (cells1, cells2)]
    order = F.struct("ts", "seq" if "seq" in cells1.columns else "value")
    values = [
        _newest(n, order, (F.col("family") == f) & (F.col("qualifier") == q)).alias(f"_{n}_{name}")
        for n in (1, 2)
        for name, (f, q) in names.items()
    ]
    present = [F.bool_or(F.col("_side") == n).alias(f"in_{n}") for n in (1, 2)]
    return _tagged_union(*narrow).groupBy("row_key").agg(*present, *values)


def joined_stored_pairs(
    cells1: DataFrame, cells2: DataFrame, catalog: Catalog, options: ReadOptions = ReadOptions()
) -> DataFrame:
    """The same by a join on the stored keys: each side moves once, or not at all where both are bucketed by key."""
    names = _stored_names(catalog)
    sides = []
    for n, cells in ((1, cells1), (2, cells2)):
        side = read_latest_wide(select_time(cells, options), names, options.restrictive)
        sides.append(side.select(*[F.col(c).alias(f"_{n}_{c}") for c in side.columns]))
    joined = sides[0].join(sides[1], F.col("_1_row_key") == F.col("_2_row_key"), "full_outer")
    return joined.select(
        F.coalesce("_1_row_key", "_2_row_key").alias("row_key"),
        *[F.col(f"_{n}_row_key").isNotNull().alias(f"in_{n}") for n in (1, 2)],
        *[F.col(f"_{n}_{name}") for n in (1, 2) for name in names],
    )


def differing_pairs(pairs: DataFrame, catalog: Catalog, null_safe: bool = True) -> DataFrame:
    """Typed rows of :func:`stored_pairs` that differ: keys, ``_1_<name>``, ``_2_<name>``, ``in_1, in_2`` and ``Diff``.

    Pairs with the same bytes have the same values, so these go first; only the rest is decoded, and
    compared once more, as one value may be stored in two ways.
    """
    names = list(_stored_names(catalog))
    same = F.col("in_1") & F.col("in_2")
    for name in names:
        same = same & F.col(f"_1_{name}").eqNullSafe(F.col(f"_2_{name}"))
    changed = pairs.filter(~same)
    decode, keys = value_decoder(catalog, pairs.schema, "_1_" + names[0] if names else None), key_columns(catalog, pairs)
    typed = changed.select(
        *keys,
        "in_1",
        "in_2",
        *[decode(F.col(f"_{n}_{c}"), catalog.column(c)).alias(f"_{n}_{c}") for n in (1, 2) for c in names],
    )
    texts = F.concat_ws("", *[F.when(_differs(c, null_safe), f"{c} ") for c in _in_table_order(catalog, names)])
    diff = F.when(~F.col("in_1"), ONLY_IN_2).when(~F.col("in_2"), ONLY_IN_1).otherwise(texts)
    return typed.withColumn(DIFF, diff).filter(F.col(DIFF) != "")


def _in_table_order(catalog: Catalog, names: Sequence[str]) -> list[str]:
    return [c.name for c in catalog.columns if c.name in names]


def stored_diff_rows(differing: DataFrame, catalog: Catalog) -> DataFrame:
    """The rows of :func:`diff_tables` from :func:`differing_pairs`."""
    picked = [
        F.col(c.name)
        if c.is_key
        else F.when(F.col("in_1"), F.col(f"_1_{c.name}")).otherwise(F.col(f"_2_{c.name}")).alias(c.name)
        for c in catalog.columns
    ]
    return differing.select(*picked, DIFF)


def stored_diff_columns(differing: DataFrame, catalog: Catalog) -> DataFrame:
    """The rows of :func:`diff_columns` from :func:`differing_pairs`."""
    keys = [c.name for c in catalog.key]
    both = differing.filter("in_1 AND in_2").select(
        *[F.col(k).alias(f"_1_{k}") for k in keys], *[c for c in differing.columns if c[:3] in ("_1_", "_2_")]
    )
    return both.select(*differing_columns(keys, [c.name for c in catalog.columns]))


def stored_diff_counts(pairs: DataFrame) -> list[Column]:
    """Aggregates over :func:`stored_pairs`: ``rows1, rows2, only_in_1, only_in_2, both``."""
    one, two = F.col("in_1"), F.col("in_2")
    return [
        F.count_if(one).alias("rows1"),
        F.count_if(two).alias("rows2"),
        F.count_if(one & ~two).alias("only_in_1"),
        F.count_if(two & ~one).alias("only_in_2"),
        F.count_if(one & two).alias("both"),
    ]


def diff_encoded_tables(
    cells1: DataFrame,
    cells2: DataFrame,
    catalog: Catalog,
    options: ReadOptions = ReadOptions(),
    null_safe: bool = True,
    join: bool = False,
) -> DataFrame:
    """:func:`diff_tables` of two cell tables with the same catalog, decoded late.

    Stored keys meet and stored values are compared; only rows that differ are decoded. Both sides are aggregated
    together, or, with ``join``, joined by key, which moves nothing where both tables are bucketed by it.
    """
    pairs = (joined_stored_pairs if join else stored_pairs)(cells1, cells2, catalog, options)
    return stored_diff_rows(differing_pairs(pairs, catalog, null_safe), catalog)


def diff_encoded_columns(
    cells1: DataFrame, cells2: DataFrame, catalog: Catalog, options: ReadOptions = ReadOptions()
) -> DataFrame:
    """:func:`diff_columns` of two cell tables with the same catalog, decoded late."""
    return stored_diff_columns(differing_pairs(stored_pairs(cells1, cells2, catalog, options), catalog), catalog)


def diff_encoded_summary(
    cells1: DataFrame, cells2: DataFrame, catalog: Catalog, options: ReadOptions = ReadOptions()
) -> DataFrame:
    """:func:`diff_summary` of two cell tables with the same catalog, in one aggregation of both sides."""
    pairs = stored_pairs(cells1, cells2, catalog, options)
    names = list(_stored_names(catalog))
    decode, one, two = value_decoder(catalog, pairs.schema, "_1_" + names[0] if names else None), F.col("in_1"), F.col("in_2")
    # Bytes that are equal are not decoded: their sides are taken as absent.
    differs = F.lit(False)
    for name in names:
        a, b = F.col(f"_1_{name}"), F.col(f"_2_{name}")
        apart = one & two & ~a.eqNullSafe(b)
        typed = [decode(F.when(apart, v), catalog.column(name)) for v in (a, b)]
        differs = differs | ~typed[0].eqNullSafe(typed[1])
    changed = F.count_if(differs).alias("changed")
    counts = pairs.agg(*stored_diff_counts(pairs), changed)
    return counts.select(
        "rows1", "rows2", "only_in_1", "only_in_2", "changed", (F.col("both") - F.col("changed")).alias("same")
    )
