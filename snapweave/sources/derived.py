"""Snapshot series derived from the driver tables.

The test tables hold one state of each table.  To exercise the history
operators we derive a series of full imports from ``orders`` (and
``lineitem`` for the larger bench runs): snapshot i leaves out the tenth of
rows with ``key % 10 = i`` (records deleted or not yet inserted) and rewrites
the status of the rows with ``key % 7 = i`` (records updated in that import).
Every snapshot is read from the whole table; the modulo rules only decide
what changes between imports.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.mask import with_legend

# The snapshot labels of the derived series (their times feed to_date).
ORDER_LABELS = (
    "/bi/orders/importdatetime=2014-01-18T01_16_16p01_00",
    "/bi/orders/importdatetime=2014-01-19T01_16_16p01_00",
    "/bi/orders/importdatetime=2014-01-20T01_16_16p01_00",
)
LINEITEM_LABELS = (
    "/bi/lineitem/importdatetime=2014-01-18T01_16_16p01_00",
    "/bi/lineitem/importdatetime=2014-01-19T01_16_16p01_00",
    "/bi/lineitem/importdatetime=2014-01-20T01_16_16p01_00",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_snapshot(spark: SparkSession, sf_dir: str, i: int) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return (orders.where(key % 10 != i)
            .withColumn("o_orderstatus",
                        F.when(key % 7 == i, F.lit(f"X{i}")).otherwise(F.col("o_orderstatus"))))


def order_snapshots(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {label: order_snapshot(spark, sf_dir, i) for i, label in enumerate(ORDER_LABELS)}


def duplicated_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot 0 plus a second copy of its rows with ``o_orderkey % 11 = 0``."""
    s0 = order_snapshot(spark, sf_dir, 0)
    return s0.unionByName(s0.where(F.col("o_orderkey") % 11 == 0))


def duplicated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``orders`` plus a second copy of the rows with ``o_orderkey % 11 = 0``."""
    orders = table(spark, sf_dir, "orders")
    return orders.unionByName(orders.where(F.col("o_orderkey") % 11 == 0))


# A long series: one import a day, each order in the imports of one interval.
LONG_LABELS = tuple(f"/bi/orders/importdatetime={date.fromordinal(date(2014, 1, 1).toordinal() + i)}T01_16_16p01_00"
                    for i in range(200))


def long_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``orders`` as a merged series of 200 imports: present from one import to another, by their keys.

    An order without a customer is in none.
    """
    n = len(LONG_LABELS)
    first = (F.col("o_custkey") % n).cast("int")
    last = F.greatest(first, (F.col("o_orderkey") % n).cast("int"))
    mask = F.concat(F.repeat(F.lit("0"), first), F.repeat(F.lit("1"), last - first + 1), F.repeat(F.lit("0"), n - 1 - last))
    return table(spark, sf_dir, "orders").select("*", with_legend(F.coalesce(mask, F.repeat(F.lit("0"), n)), LONG_LABELS))


def long_history_sql(position: int) -> str:
    """The orders present at one position of :func:`long_history`."""
    n = len(LONG_LABELS)
    return (f"SELECT * FROM orders WHERE o_custkey % {n} <= {position} "
            f"AND greatest(o_custkey % {n}, o_orderkey % {n}) >= {position}")


def lineitem_snapshot(spark: SparkSession, sf_dir: str, i: int) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    return (items.where(key % 10 != i)
            .withColumn("l_linestatus",
                        F.when(key % 7 == i, F.lit(f"X{i}")).otherwise(F.col("l_linestatus"))))


def lineitem_snapshots(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {label: lineitem_snapshot(spark, sf_dir, i) for i, label in enumerate(LINEITEM_LABELS)}


# SQL text of the same derivation, for the DuckDB oracle.
def order_snapshot_sql(i: int) -> str:
    return (f"SELECT o_orderkey, o_custkey, "
            f"CASE WHEN o_orderkey % 7 = {i} THEN 'X{i}' ELSE o_orderstatus END AS o_orderstatus, "
            f"o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 <> {i}")


def lineitem_snapshot_sql(i: int) -> str:
    return (f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            f"l_discount, l_tax, l_returnflag, "
            f"CASE WHEN l_orderkey % 7 = {i} THEN 'X{i}' ELSE l_linestatus END AS l_linestatus, "
            f"l_shipdate FROM lineitem WHERE l_orderkey % 10 <> {i}")
