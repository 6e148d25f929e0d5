"""Queries: predicates on a typed read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrecon.operators import predicates
from queryset.registry import query
from queryset.tables import customers, sql, table


def _where(name: str, condition: str, spark_condition: Callable[[], Column]) -> None:
    """Register one filter on the typed customer table."""

    def run(spark, d) -> DataFrame:
        return customers(spark, d).filter(spark_condition())

    body = f"SELECT custkey, status, price, priority FROM customers WHERE {condition}"
    query(name, sql(body, "customers"))(run)


_where("pred_eq", "status = 'F'", lambda: F.col("status") == "F")
_where("pred_ne", "NOT priority = '1-URGENT'", lambda: ~(F.col("priority") == "1-URGENT"))
_where(
    "pred_lt_le",
    "price < 40000000 AND price <= 35000000 AND NOT price > 30000000 AND NOT price >= 25000000",
    lambda: (F.col("price") < 40000000)
    & (F.col("price") <= 35000000)
    & ~(F.col("price") > 30000000)
    & ~(F.col("price") >= 25000000),
)
_where(
    "pred_gt_ge",
    "price > 5000000 AND price >= 6000000 AND NOT price < 10000000 AND NOT price <= 12000000",
    lambda: (F.col("price") > 5000000)
    & (F.col("price") >= 6000000)
    & ~(F.col("price") < 10000000)
    & ~(F.col("price") <= 12000000),
)
_where(
    "pred_starts_with", "starts_with(priority, '4-NOT')", lambda: F.col("priority").startswith("4-NOT")
)
_where("pred_ends_with", "ends_with(priority, 'LOW')", lambda: F.col("priority").endswith("LOW"))
_where("pred_contains", "contains(priority, 'SPEC')", lambda: F.col("priority").contains("SPEC"))
_where(
    "pred_not_contains", "NOT contains(priority, 'SPEC')", lambda: ~F.col("priority").contains("SPEC")
)
_where(
    "pred_in_minus_not_in",
    "priority IN ('1-URGENT', '2-HIGH', '5-LOW') AND priority NOT IN ('2-HIGH')",
    lambda: predicates.in_minus_not_in("priority", ["1-URGENT", "2-HIGH", "5-LOW"], ["2-HIGH"]),
)
_where(
    "pred_and",
    "status = 'O' AND price > 10000000",
    lambda: (F.col("status") == "O") & (F.col("price") > 10000000),
)
_where(
    "pred_or",
    "custkey < 200 OR priority = '5-LOW'",
    lambda: (F.col("custkey") < 200) | (F.col("priority") == "5-LOW"),
)
_where(
    "pred_not_and_or",
    "NOT (status = 'O' AND priority = '5-LOW') AND NOT (price < 5000000 OR status = 'P')",
    lambda: ~((F.col("status") == "O") & (F.col("priority") == "5-LOW"))
    & ~((F.col("price") < 5000000) | (F.col("status") == "P")),
)
_where(
    "pred_other",
    "priority IS NULL OR (status IS NOT NULL AND price - custkey > 30000000)",
    lambda: F.col("priority").isNull()
    | (F.col("status").isNotNull() & (F.col("price") - F.col("custkey") > 30000000)),
)


@query(
    "pred_in",
    sql(
        """SELECT custkey, status, price, priority FROM customers
        WHERE priority IN ('1-URGENT', '2-HIGH')
          AND custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
        "customers",
    ),
)
def pred_in(spark, d):
    rows = predicates.in_values(customers(spark, d), "priority", ["1-URGENT", "2-HIGH"])
    solvent = table(spark, d, "customer").filter(F.col("c_acctbal") > 0).select("c_custkey")
    return predicates.in_values(rows, "custkey", solvent)


@query(
    "pred_not_in",
    sql(
        """SELECT custkey, status, price, priority FROM customers
        WHERE priority NOT IN ('1-URGENT', '2-HIGH')
          AND custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
        "customers",
    ),
)
def pred_not_in(spark, d):
    rows = predicates.not_in_values(customers(spark, d), "priority", ["1-URGENT", "2-HIGH"])
    customer = table(spark, d, "customer")
    building = customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return predicates.not_in_values(rows, "custkey", building)
