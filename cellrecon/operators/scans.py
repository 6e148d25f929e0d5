"""Selecting cells: by time, by version, by column, by key.

All of these keep the cell layout, and all but :func:`newest_versions` are plain filters that reach
the scan. Time and column selections belong *below* any latest-value step: the time range selects
which versions exist, it does not test the newest one.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrecon.options import ReadOptions
from cellrecon.session import written
from cellrecon.sources.cells import CELL

# Above this many versions Spark's own limit on ranked rows no longer works ahead of the shuffle.
_RANK_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
# Stretches of time that a cell's versions are counted in at a time, and salts for its join with what was found.
_STRETCHES = 4096
_SALTS = 32


def scan_cells(
    cells: DataFrame, columns: Sequence[str] | None = None, condition: Column | None = None
) -> DataFrame:
    """All cells, reduced to the wanted columns and rows."""
    if condition is not None:
        cells = cells.filter(condition)
    return cells if columns is None else cells.select(*columns)


def scan_time_range(cells: DataFrame, min_ts: int | None, max_ts: int | None) -> DataFrame:
    """Cells with ``min_ts <= ts < max_ts``; both bounds are required."""
    if min_ts is None or max_ts is None:
        raise ValueError("a time range needs both a minimum and a maximum")
    return cells.filter((F.col("ts") >= min_ts) & (F.col("ts") < max_ts))


def scan_at_timestamp(cells: DataFrame, ts: int) -> DataFrame:
    """Cells written at exactly ``ts``."""
    return cells.filter(F.col("ts") == ts)


def select_time(cells: DataFrame, options: ReadOptions) -> DataFrame:
    """Cells of the versions that the options' timestamp or time range selects."""
    if options.timestamp is not None:
        return scan_at_timestamp(cells, options.timestamp)
    if options.min_ts is not None:
        return scan_time_range(cells, options.min_ts, options.max_ts)
    return cells


def project_columns(cells: DataFrame, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """Cells of the named ``(family, qualifier)`` columns, one list of qualifiers for each family."""
    families: dict[str, list[str]] = {}
    for family, qualifier in dict.fromkeys(columns):
        families.setdefault(family, []).append(qualifier)
    terms = [(F.col("family") == f) & one_of("qualifier", q) for f, q in families.items()]
    while len(terms) > 1:  # in halves, so that many families don't make a deep expression
        pairs = zip(terms[::2], terms[1::2], strict=False)
        terms = [a | b for a, b in pairs] + terms[len(terms) // 2 * 2 :]
    return cells.filter(terms[0] if terms else F.lit(False))


def one_of(column: str, texts: Iterable[str]) -> Column:
    """``column`` is one of these texts. Written as SQL, a list of thousands reaches Spark in one piece.

    Texts are given by their bytes, which no setting of the parser reads in another way.
    """
    quoted = [f"CAST(X'{t.encode().hex()}' AS STRING)" for t in texts]
    return F.expr(f"{column} IN ({', '.join(quoted)})") if quoted else F.lit(False)


def project_families(cells: DataFrame, families: Iterable[str]) -> DataFrame:
    """Cells of the named families."""
    return cells.filter(one_of("family", families))


def distinct_versions(cells: DataFrame) -> DataFrame:
    """One row per cell and ``ts``: a value rewritten at the same ``ts`` replaces the earlier one."""
    value = F.max_by("value", "seq") if "seq" in cells.columns else F.max("value")
    return cells.groupBy(*CELL, "ts").agg(value.alias("value"))


def latest_cells(cells: DataFrame) -> DataFrame:
    """The newest value of every cell.

    Aggregated before the shuffle, so a cell with very many versions costs one row per task.
    """
    # Without a sequence the greater of two values for the same time holds, as in version reads.
    order = F.struct("ts", "seq" if "seq" in cells.columns else "value")
    return cells.groupBy(*CELL).agg(
        F.max("ts").alias("ts"), F.max_by(F.col("value"), order).alias("value")
    )


def newest_versions(cells: DataFrame, n: int, *, unique: bool = False) -> DataFrame:
    """The newest ``n`` versions of every cell.

    ``unique`` states that no cell has two values with the same ``ts`` and saves a shuffle. Up to the
    threshold of Spark's own limit on ranked rows the ranking is cut in every map task before the shuffle, so one
    cell that holds much of the table does not end up in a single task. Beyond it nothing is ranked: the time of each
    cell's n-th newest version is found by counting (:func:`nth_newest`), and earlier versions are dropped.
    """
    if n < 1:
        raise ValueError("at least one version has to be kept")
    if n == 1:
        return latest_cells(cells)
    versions = cells if unique else distinct_versions(cells)
    if n <= int(cells.sparkSession.conf.get(_RANK_LIMIT_CONF, "1000")):
        newest_first = Window.partitionBy(*CELL).orderBy(F.desc("ts"))
        ranked = versions.withColumn("_rank", F.row_number().over(newest_first))
        return ranked.filter(F.col("_rank") <= n).select(*CELL, "ts", "value")
    stored = written(versions.select(*CELL, "ts", "value"), "versions")
    since = nth_newest(stored, n).withColumnRenamed("ts", "_since")
    kept = _beside(stored, since, "left").filter(F.col("_since").isNull() | (F.col("ts") >= F.col("_since")))
    return kept.select(*CELL, "ts", "value")


def nth_newest(versions: DataFrame, n: int) -> DataFrame:
    """``row_key, family, qualifier, ts``: the time of the n-th newest version of each cell that has so many.

    Versions are counted by cell and stretch of time, in map tasks first. Running sums over a cell's stretches,
    at most ``_STRETCHES`` of them, tell in which one its n-th newest version lies, and only that one is counted again in
    finer stretches, down to single milliseconds. How many rounds that takes follows from the span of times alone.
    """
    span = versions.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if span["lo"] is None:
        return versions.select(*CELL, "ts")
    width = 1
    while width * _STRETCHES <= span["hi"] - span["lo"]:
        width *= _STRETCHES
    # The stretch in which the version lies: its start, and the how manieth newest in it the version is.
    sought = None
    rows = versions.select(*CELL, "ts")
    while True:
        if sought is None:
            inside = rows.withColumns({"_start": F.lit(span["lo"]).cast("bigint"), "_want": F.lit(n).cast("bigint")})
        else:
            wider = width * _STRETCHES
            inside = _beside(rows, sought, "inner").filter(
                (F.col("ts") >= F.col("_start")) & (F.col("ts") < F.col("_start") + wider)
            )
        stretch = F.floor((F.col("ts") - F.col("_start")) / width).cast("bigint")
        counts = inside.groupBy(*CELL, "_start", "_want", stretch.alias("_stretch")).agg(F.count(F.lit(1)).alias("_n"))
        newest_first = Window.partitionBy(*CELL).orderBy(F.desc("_stretch")).rowsBetween(Window.unboundedPreceding, 0)
        summed = counts.withColumn("_sum", F.sum("_n").over(newest_first))
        reached = (F.col("_sum") >= F.col("_want")) & (F.col("_sum") - F.col("_n") < F.col("_want"))
        start = F.col("_start") + F.col("_stretch") * width
        sought = written(
            summed.filter(reached).select(
                *CELL, start.alias("_start"), (F.col("_want") - F.col("_sum") + F.col("_n")).alias("_want")
            ),
            "stretches",
        )
        if width == 1:
            return sought.select(*CELL, F.col("_start").alias("ts"))
        width //= _STRETCHES


def _beside(versions: DataFrame, of_cells: DataFrame, how: str) -> DataFrame:
    """Versions with what ``of_cells`` has for their cell, which has more than a thousand versions where it has any.

    Versions of one cell are dealt over salts and the few rows of ``of_cells`` repeated for each, so that no
    cell has to meet in one task.
    """
    salt = F.pmod(F.xxhash64("ts"), F.lit(_SALTS)).cast("int")
    repeated = of_cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return versions.withColumn("_salt", salt).join(repeated, [*CELL, "_salt"], how).drop("_salt")


def multi_get(rows: DataFrame, keys: DataFrame | Sequence, key: str = "row_key") -> DataFrame:
    """Rows whose key is in a list of keys, given as values or as a one-column DataFrame.

    A list becomes a predicate, whatever its length, with each value cast to the key's type. A
    DataFrame is semi-joined; which side travels is left to Spark, which knows the sizes.
    """
    if not isinstance(keys, DataFrame):
        kind = rows.schema[key].dataType
        return rows.filter(F.col(key).isin([F.lit(k).cast(kind) for k in keys]))
    return rows.join(keys.toDF(key).distinct(), key, "left_semi")
