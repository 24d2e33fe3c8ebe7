"""Flights derived from the order tables, one per line item of the whole table.

Carrier is the part's brand, origin the supplier's nation, destination the customer's,
delay the days from order to shipment. A returned line plays the cancelled flight, line
number 7 the diverted one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# The columns used of each table. Stating them spares a footer-reading job per table.
_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_brand string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with carrier, origin, dest, month and delay.

    The nations are looked up for suppliers and customers, and customers meet the orders
    before the more numerous line items do: no fact row is ever shuffled by a nation, of
    which there are few. No broadcast is forced: the planner broadcasts a table whose file size is below
    the session's threshold and otherwise joins by shuffle, where adaptive execution
    splits a part, supplier or order that very many lines share.
    """
    lines, suppliers, parts, customers = (
        _table(spark, folder, name) for name in ("lineitem", "supplier", "part", "customer")
    )
    nations = _table(spark, folder, "nation")
    origins = nations.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin"))
    dests = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dest"))
    suppliers = suppliers.join(origins, "s_nationkey").drop("s_nationkey")
    customers = customers.join(dests, "c_nationkey").drop("c_nationkey")
    orders = _table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumnRenamed("p_brand", "op_unique_carrier")
        .withColumn("month", F.month("o_orderdate"))
        .withColumn("days", F.datediff("l_shipdate", "o_orderdate").cast("double"))
    )


def _dep_delay() -> Column:
    unrecorded = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return F.when(~unrecorded, F.col("days"))


def _arr_delay() -> Column:
    unrecorded = (F.col("l_returnflag") == "R") | (F.col("l_linenumber") == 7)
    return F.when(~unrecorded, F.col("days") + F.col("l_quantity") - 25)


def _cancelled() -> Column:
    return F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)


def voli(spark: SparkSession, folder: str) -> DataFrame:
    """Typed flights."""
    return _joined(spark, folder).select(
        "month",
        "op_unique_carrier",
        "origin",
        "dest",
        _dep_delay().alias("dep_delay"),
        _arr_delay().alias("arr_delay"),
        _cancelled().alias("cancelled"),
    )


def _spoiled(value: Column, key: Column, defects: dict[int, str | None]) -> Column:
    """``value`` as text, replaced where ``key`` leaves one of the remainders modulo 101."""
    remainder = key % 101
    first, *others = defects.items()
    text = F.when(remainder == first[0], F.lit(first[1]))
    for number, defect in others:
        text = text.when(remainder == number, F.lit(defect))
    return text.otherwise(value)


def voli_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The same flights as text, as a careless file would hold them.

    No row is left out: depending on the order or part number, some fields of some rows
    are made bad, blank, padded or missing, and some rows become header lines.
    """
    joined = _joined(spark, folder)
    order, part = F.col("l_orderkey"), F.col("l_partkey")

    def whole(value: Column) -> Column:
        return value.cast("bigint").cast("string")

    padded = F.concat(F.lit("  "), F.col("op_unique_carrier"), F.lit("\t"))
    return joined.select(
        _spoiled(F.col("month").cast("string"), order, {1: "x", 2: "", 3: "month"}).alias("month"),
        _spoiled(
            F.when(part % 3 == 0, padded).otherwise(F.col("op_unique_carrier")),
            order,
            {3: "op_unique_carrier", 4: "OP_Unique_Carrier", 5: " \t ", 6: None},
        ).alias("op_unique_carrier"),
        _spoiled(F.col("origin"), part, {7: None, 8: "  "}).alias("origin"),
        _spoiled(F.col("dest"), part, {9: None, 10: ""}).alias("dest"),
        _spoiled(whole(_dep_delay()), order, {11: "None", 12: "", 13: "late", 14: " 7.5 "}).alias("dep_delay"),
        _spoiled(whole(_arr_delay()), part, {15: " None ", 16: "  ", 17: "1,5"}).alias("arr_delay"),
        _spoiled(_cancelled().cast("string"), order, {18: "", 19: "n/a", 20: " 0"}).alias("cancelled"),
    )
