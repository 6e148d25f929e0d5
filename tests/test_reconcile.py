from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from cellrecon import ReadOptions, Restrictive, parse_catalog, read_table, write_table
from cellrecon.operators import reconcile
from cellrecon.operators.reads import cells_per_row, family_entries, read_dynamic_family

SCHEMA = "key string, age int, level string"
CELLS = "row_key string, family string, qualifier string, ts long, value string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def pair(spark):
    first = [("same", 1, "a"), ("both", 1, "a"), ("one", 1, "a"), ("null", None, "a"), ("left", 9, "z")]
    second = [("same", 1, "a"), ("both", 2, "b"), ("one", 1, "b"), ("null", 5, "a"), ("right", 8, "y")]
    return spark.createDataFrame(first, SCHEMA), spark.createDataFrame(second, SCHEMA)


def test_diff_texts_and_values(pair):
    assert rows(reconcile.diff_tables(*pair, "key")) == sorted(
        [
            ("both", 1, "a", "age level "),
            ("left", 9, "z", "New row in DataFrame 1"),
            ("null", None, "a", "age "),
            ("one", 1, "a", "level "),
            ("right", 8, "y", "New row in DataFrame 2"),
        ],
        key=repr,
    )


def test_diff_without_null_safety_misses_the_null(pair):
    found = {r[0] for r in rows(reconcile.diff_tables(*pair, "key", null_safe=False))}
    assert found == {"both", "left", "one", "right"}


def test_diff_of_a_table_with_itself_is_empty(pair):
    assert reconcile.diff_tables(pair[0], pair[0], "key").count() == 0


def test_diff_needs_the_first_tables_columns(pair):
    with pytest.raises(ValueError, match="no column"):
        reconcile.diff_tables(pair[0], pair[1].drop("level"), "key")


def test_key_check(spark, pair):
    twice = pair[0].union(pair[0].limit(1))
    with pytest.raises(ValueError, match="not unique"):
        reconcile.diff_tables(twice, pair[1], "key", check_keys=True)
    unkeyed = spark.createDataFrame([(None, 1, "a")], SCHEMA)
    with pytest.raises(ValueError, match="null"):
        reconcile.diff_tables(unkeyed, pair[1], "key", check_keys=True)
    assert reconcile.diff_tables(*pair, "key", check_keys=True).count() == 5


def test_composite_keys(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, l int, v string")
    b = spark.createDataFrame([(1, 1, "x"), (1, 2, "z"), (2, 1, "w")], "k int, l int, v string")
    assert rows(reconcile.diff_tables(a, b, ["k", "l"])) == [
        (1, 2, "y", "v "),
        (2, 1, "w", "New row in DataFrame 2"),
    ]


def test_diff_columns(pair):
    assert rows(reconcile.diff_columns(*pair, "key")) == [
        ("both", "age", "1", "2"),
        ("both", "level", "a", "b"),
        ("null", "age", None, "5"),
        ("one", "level", "a", "b"),
    ]


def test_properties_on_random_tables(spark):
    rnd = random.Random(3)

    def table():
        keys = rnd.sample(range(60), 40)
        data = [(str(k), rnd.choice([None, 1, 2]), rnd.choice([None, "a", "b"])) for k in keys]
        return spark.createDataFrame(data, SCHEMA)

    for _ in range(3):
        a, b = table(), table()
        there, back = (rows(reconcile.diff_tables(x, y, "key")) for x, y in ((a, b), (b, a)))
        assert [r[0] for r in there] == [r[0] for r in back]
        changed = {r[0] for r in there if not r[3].startswith("New row")}
        assert changed == {r[0] for r in rows(reconcile.diff_columns(a, b, "key"))}
        s = reconcile.diff_summary(a, b, "key").first()
        assert s.rows1 == s.rows2 == 40
        assert s.changed == len(changed)
        assert s.only_in_1 + s.only_in_2 + s.changed == len(there)
        assert s.only_in_1 + s.changed + s.same == 40


def test_column_except_counts_nulls_as_values(spark):
    a = spark.createDataFrame([(1, "x"), (1, None), (2, "y")], "n int, s string")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "n int, s string")
    assert rows(reconcile.column_except(a, b)) == [("n", "1"), ("s", None)]
    assert rows(reconcile.column_except(a, b, ["s"])) == [("s", None)]


def test_row_counts_and_left_pair(pair):
    assert tuple(reconcile.compare_row_counts(*pair).first()) == (5, 5, True)
    assert tuple(reconcile.compare_row_counts(pair[0], pair[1].limit(2)).first()) == (5, 2, False)
    joined = reconcile.left_outer_pair(*pair, "key")
    assert joined.columns == ["key_1", "age_1", "level_1", "key_2", "age_2", "level_2"]
    assert joined.count() == 5 and joined.filter("key_2 is null").count() == 1


def test_preview_and_selection(pair):
    assert [r.key for r in reconcile.preview_rows(pair[0], "key", 2).collect()] == ["both", "left"]
    assert reconcile.select_columns(pair[0], ["key"], ["level", "key"]).columns == ["key", "level"]


@pytest.fixture(scope="module")
def cell_pair(spark):
    first = [("a", "f", "x", 1, "1"), ("a", "f", "y", 1, "2"), ("b", "f", "x", 1, "3"), ("c", "f", "x", 1, "4")]
    second = [("a", "f", "x", 1, "1"), ("b", "f", "x", 1, "9"), ("d", "f", "x", 1, "4")]
    return spark.createDataFrame(first, CELLS), spark.createDataFrame(second, CELLS)


def test_count_diff_reports_only_counts_on_both_sides(cell_pair):
    counts = [cells_per_row(c) for c in cell_pair]
    mismatch = reconcile.count_mismatch_join(*counts)
    assert rows(mismatch) == [("a", 2, "a", 1)]
    expected = [("a", 0, {"x": "1", "y": "2"}, {"x": "1"})]
    assert rows(reconcile.diff_by_cell_count(*cell_pair, "f")) == expected
    maps = [read_dynamic_family(c, "f") for c in cell_pair]
    assert rows(reconcile.detail_lookup_join(mismatch, *maps)) == expected


def test_cell_diff_reports_everything(cell_pair):
    assert rows(reconcile.diff_cells(*cell_pair)) == rows(reconcile.diff_family(*cell_pair, "f")) == [
        ("a", "y", "2", None, "New row in DataFrame 1"),
        ("b", "x", "3", "9", "value "),
        ("c", "x", "4", None, "New row in DataFrame 1"),
        ("d", "x", None, "4", "New row in DataFrame 2"),
    ]


def test_count_diff_of_outsize_rows(spark):
    def cells(n):
        return spark.range(n).select(
            F.lit("hot").alias("row_key"),
            F.lit("f").alias("family"),
            F.concat(F.lit("q"), "id").alias("qualifier"),
            F.lit(1).cast("long").alias("ts"),
            F.col("id").cast("string").alias("value"),
        )

    found = reconcile.diff_by_cell_count(cells(300), cells(100), "f", parts=6)
    assert found.count() == 6
    for column, n in (("Table_Cluster1", 300), ("Table_Cluster2", 100)):
        assert found.select(F.explode(column)).count() == n


def _part_of(documents, column):
    """The part of each qualifier of a side, which stands in one document only."""
    found = [(q, d["part"]) for d in documents for q in d[column] or ()]
    assert len(found) == len(dict(found))
    return dict(found)


@pytest.mark.parametrize("parts", [1, 4])
def test_a_qualifier_is_in_the_same_document_on_both_sides(spark, parts):
    def cells(n):
        return spark.createDataFrame([("hot", "f", f"q{i}", 1, str(i)) for i in range(n)], CELLS).coalesce(1)

    # Two parts against one if each side were cut by its own count.
    one, two = cells(150), cells(90)
    mismatch = spark.createDataFrame([("hot", 150, "hot", 90)], "rowkey1 string, count1 long, rowkey2 string, count2 long")
    maps = [read_dynamic_family(c, "f", parts=parts) for c in (one, two)]
    for found in (
        reconcile.diff_by_cell_count(one, two, "f", parts=parts).collect(),
        reconcile.detail_lookup_join(mismatch, *maps).collect(),
    ):
        assert len(found) == parts
        first, second = (_part_of(found, f"Table_Cluster{n}") for n in (1, 2))
        assert len(first) == 150 and len(second) == 90 and second.items() <= first.items()


def random_cells(chance, n, keys):
    return [
        (
            "hot" if i % 3 == 0 else f"k{chance.randint(0, keys)}",
            chance.choice("fg"),
            f"q{chance.randint(0, 5)}",
            chance.randint(0, 20),
            i,
            chance.choice([None, "1", "2", "3"]),
        )
        for i in range(n)
    ]


SEQ_CELLS = "row_key string, family string, qualifier string, ts long, seq long, value string"


@pytest.mark.parametrize("seed", range(3))
def test_one_aggregation_gives_what_the_joins_give(spark, seed):
    """A key with a third of the cells, missing values, keys and columns on one side only."""
    chance = random.Random(seed)
    one, two = (spark.createDataFrame(random_cells(chance, 300, 60), SEQ_CELLS) for _ in range(2))
    joined = reconcile.diff_cells(*[family_entries(c, "f") for c in (one, two)])
    assert rows(reconcile.diff_family(one, two, "f")) == rows(joined)
    counts = reconcile.count_mismatch_join(*[cells_per_row(c) for c in (one, two)])
    assert rows(reconcile.count_mismatches(one, two)) == rows(counts)

    columns = {"id": {"cf": "rowkey", "col": "k", "type": "string"}}
    columns |= {f"c{i}": {"cf": "f", "col": f"q{i}", "type": "int"} for i in range(3)}
    catalog = parse_catalog(json.dumps({"table": {"name": "t"}, "rowkey": "k", "columns": columns}))
    for options in (ReadOptions(), ReadOptions(min_ts=3, max_ts=15), ReadOptions(restrictive=Restrictive.NONE)):
        tables = [read_table(c, catalog, options) for c in (one, two)]
        for null_safe in (True, False):
            expected = rows(reconcile.diff_tables(*tables, "id", null_safe=null_safe))
            for join in (True, False):
                found = reconcile.diff_encoded_tables(one, two, catalog, options, null_safe, join)
                assert rows(found) == expected
        assert rows(reconcile.diff_encoded_columns(one, two, catalog, options)) == rows(reconcile.diff_columns(*tables, "id"))
        assert rows(reconcile.diff_encoded_summary(one, two, catalog, options)) == rows(reconcile.diff_summary(*tables, "id"))


def test_one_value_stored_in_two_ways_is_no_difference(spark):
    """Both zeros are one number; their bytes differ, so they are decoded and compared again."""
    columns = {"id": {"cf": "rowkey", "col": "k", "type": "int"}, "x": {"cf": "f", "col": "x", "type": "double"}}
    catalog = parse_catalog(json.dumps({"table": {"name": "t"}, "rowkey": "k", "columns": columns}))
    one = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, None)], catalog.schema)
    two = spark.createDataFrame([(1, -0.0), (2, 2.0), (3, 5.0)], catalog.schema)
    sides = [write_table(df, catalog, ts=1).withColumn("seq", F.lit(1)) for df in (one, two)]
    more = [c.unionByName(c.limit(1).withColumns({"qualifier": F.lit("y"), "row_key": F.lit(bytearray(b"\0\0\0\3"))})) for c in sides]
    options = ReadOptions(restrictive=Restrictive.FAMILY)
    assert rows(reconcile.diff_encoded_tables(*more, catalog, options)) == [(2, 1.0, "x "), (3, None, "x ")]
    assert rows(reconcile.diff_encoded_tables(*more, catalog, options, null_safe=False)) == [(2, 1.0, "x ")]
    assert rows(reconcile.diff_encoded_summary(*more, catalog, options)) == [(3, 3, 0, 0, 2, 1)]
