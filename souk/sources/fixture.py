"""The ``transactions_raw`` view: invoice lines derived from the star-schema
test tables, with planted dirt for the cleaning rules (FIXTURES.md §2).

The invoice lines are exchanged as seldom as the tables allow. Suppliers,
nations and parts are broadcast while their files are small; past the size at
which orders can be broadcast too, orders meet their customers first, so that
lines move by order (and by part, if there are many) and by nothing else. AQE
splits skewed join partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import planned_bytes

#: Files of a dimension that is broadcast take no more bytes than this, and
#: those of orders that needn't meet their customers first.
NEAR_BYTES, FEW_ORDERS_BYTES = 32 << 20, 10 << 20

# Columns of the star-schema tables that the view reads. Giving the schema
# skips footer-based schema inference on every read.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "part": "p_partkey BIGINT, p_type STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str, typed: bool = False) -> DataFrame:
    """One star-schema table; ``typed`` reads just the view's columns with
    their known types."""
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if typed else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def malls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(shopping_mall)``, one row per mall, from the stored dimension tables
    (the planner bounds their size)."""
    supplier, nation = (read_table(spark, sf_dir, t, typed=True) for t in ("supplier", "nation"))
    used = nation.join(supplier, nation.n_nationkey == supplier.s_nationkey, "left_semi")
    return used.select(F.concat(F.lit("Mall of "), F.col("n_name")).alias("shopping_mall"))


def near(dim: DataFrame) -> DataFrame:
    """A dimension, broadcast if its files are small."""
    return F.broadcast(dim) if planned_bytes(dim) <= NEAR_BYTES else dim


def transactions_raw(spark: SparkSession, sf_dir: str, few_orders: int = FEW_ORDERS_BYTES) -> DataFrame:
    """Ten raw text-ish columns, one row per ``lineitem`` row."""
    li, orders, customer, part, supplier, nation = (
        read_table(spark, sf_dir, t, typed=True) for t in ("lineitem", "orders", "customer", "part", "supplier", "nation")
    )

    parted = li.join(near(part), F.col("l_partkey") == part.p_partkey)
    ordered, bought = F.col("l_orderkey") == orders.o_orderkey, F.col("o_custkey") == customer.c_custkey
    if planned_bytes(orders) > few_orders:
        sold = parted.join(orders.join(customer, bought), ordered)
    else:
        sold = parted.join(orders, ordered).join(customer, bought)
    j = sold.join(near(supplier), F.col("l_suppkey") == supplier.s_suppkey).join(
        near(nation), F.col("s_nationkey") == nation.n_nationkey
    )

    ok, ck, pk, ln = F.col("l_orderkey"), F.col("o_custkey"), F.col("l_partkey"), F.col("l_linenumber")
    ship = F.col("l_shipdate")
    invoice_no = (
        F.when(ok % 113 == 0, F.concat(F.lit("test"), _s(ok)))
        .when(ok % 131 == 0, F.lit(""))
        .when(ln % 5 == 0, F.concat(F.lit("  I"), _s(ok), F.lit(" ")))
        .otherwise(F.concat(F.lit("I"), _s(ok)))
    )
    customer_id = (
        F.when(ck % 137 == 0, F.lit(None).cast("string"))
        .when(ck % 139 == 0, F.lit(""))
        .when(ck % 149 == 0, F.lit("NA"))
        .otherwise(F.concat(F.lit("C"), _s(ck)))
    )
    gender = F.when(F.col("c_nationkey") % 2 == 0, F.lit("Female")).otherwise(F.lit("Male"))
    age = F.when(ck % 41 == 0, F.lit(None).cast("string")).otherwise(_s(F.lit(18) + ck % 52))
    category = (
        F.when(pk % 127 == 0, F.lit("Dummy item"))
        .when(ok % 499 == 0, F.concat(F.lit("Rare "), _s(ok)))
        .when(F.col("p_type") == "STANDARD", F.lit("STANDARD & MIXED"))
        .otherwise(F.col("p_type"))
    )
    quantity = (
        F.when(ok % 101 == 0, F.lit("0"))
        .when(ok % 103 == 0, F.lit("5000"))
        .when(ok % 107 == 0, F.lit(""))
        .otherwise(_s(F.col("l_quantity").cast("int")))
    )
    price = (
        F.when(ok % 109 == 0, F.lit("200000"))
        .when(ok % 151 == 0, F.lit("-1"))
        .when(ok % 157 == 0, F.lit("1,500.25"))
        .otherwise(_s((F.col("l_extendedprice") / 500).cast("decimal(18,5)")))
    )
    invoice_date = (
        F.when(ok % 163 == 0, F.lit("bad"))
        .when(ln % 4 == 0, F.date_format(ship, "yyyy-M-d"))
        .when(ln % 4 == 1, F.date_format(ship, "yyyy/MM/dd"))
        .when((ln == 2) & (F.dayofmonth(ship) > 12), F.date_format(ship, "M/d/yyyy"))
        .otherwise(F.date_format(ship, "d/M/yyyy"))
    )
    shopping_mall = F.concat(F.lit("Mall of "), F.col("n_name"))
    return j.select(
        invoice_no.alias("invoice_no"),
        customer_id.alias("customer_id"),
        gender.alias("gender"),
        age.alias("age"),
        category.alias("category"),
        quantity.alias("quantity"),
        price.alias("price"),
        F.col("o_orderpriority").alias("payment_method"),
        invoice_date.alias("invoice_date"),
        shopping_mall.alias("shopping_mall"),
    )
