"""Retail landing data derived from the analytics tables, whole and repeatable.

The tables are clean, so dirt is placed by arithmetic on keys, which any SQL engine
repeats. Everything is text before cleaning, as in raw files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.names import IS_CURRENT, VALID_FROM, VALID_TO
from stratamart.operators.dedupe import first_per_key

RATE_CURRENCIES = ("EUR", "GBP", "INR", "JPY", "CAD", "AUD", "CNY")

# A key this far above all others refers to nothing.
NOWHERE = 1_000_000_000

LINE_ORDER = ("l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _every(key: Column, n: int, rest: int) -> Column:
    return key % n == rest


def _money(amount: str) -> Column:
    return F.col(amount).cast("decimal(10,2)").cast("string")


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.cast("string").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.when(_every(key, 16, 3), F.lower("p_type"))
        .when(_every(key, 16, 5), F.upper("p_type"))
        .otherwise(F.col("p_type"))
        .alias("Category"),
        F.when(_every(key, 17, 4), "N/A").otherwise(F.split("p_name", " ")[1]).alias("SubCategory"),
        F.when(_every(key, 19, 6), "").otherwise(F.col("p_brand")).alias("Brand"),
        F.when(_every(key, 31, 8), F.concat(F.lit("$"), _money("p_retailprice")))
        .when(_every(key, 37, 9), "0")
        .when(_every(key, 41, 10), "1-2")
        .otherwise(_money("p_retailprice"))
        .alias("CostPrice"),
    )


def raw_customers(spark: SparkSession, folder: str, batch: int = 1) -> DataFrame:
    """Batch 1 is every customer; batch 2 those who moved on 1998-06-15."""
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 7, "0")
    phone = (
        F.when(_every(key, 16, 2), "N/A")
        .when(_every(key, 5, 1), F.concat(F.lit("(555)"), F.substring(digits, 1, 3), F.lit("-"), F.substring(digits, 4, 4)))
        .when(_every(key, 5, 2), F.concat(F.lit("555."), digits, F.lit("x19")))
        .when(_every(key, 29, 3), F.substring(digits, 1, 6))
        .otherwise(F.concat(F.lit("555"), digits))
    )
    rows = table(spark, folder, "customer")
    moved = batch == 2
    if moved:
        rows = rows.filter(_every(key, 4, 0))
    city = F.lit("MOVED") if moved else F.when(_every(key, 19, 3), "").otherwise(F.col("c_mktsegment"))
    changed_on = F.lit("1998-06-15 00:00:00" if moved else "1994-12-31 00:00:00")
    return rows.select(
        key.cast("string").alias("CustomerID"),
        F.split("c_name", "#")[0].alias("FirstName"),
        F.split("c_name", "#")[1].alias("LastName"),
        F.when(_every(key, 17, 1), "none").otherwise(F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com"))).alias("Email"),
        phone.alias("Phone"),
        city.alias("City"),
        F.when(_every(key, 13, 4), F.lit(" st")).otherwise(F.lit("NT")).alias("State"),
        F.when(_every(key, 43, 5), "1994-13-31 00:00:00").otherwise(changed_on).alias("LastUpdated"),
    )


def keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items keyed by OrderID, repeats included."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One raw order per OrderID; what groups by it next finds the rows together already."""
    key = F.col("id")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = keyed_lines(spark, folder).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = first_per_key(lines.withColumn("OrderID", key.cast("string")), ["OrderID"], [F.col(c).asc() for c in LINE_ORDER])
    customer = F.when(_every(key, 23, 1), F.col("o_custkey") + NOWHERE).otherwise(F.col("o_custkey"))
    product = F.when(_every(key, 29, 2), F.col("l_partkey") + NOWHERE).otherwise(F.col("l_partkey"))
    store = F.concat(F.lit("ST"), F.lpad((F.col("l_suppkey") % 10 + 1).cast("string"), 3, "0"))
    return lines.select(
        "OrderID",
        customer.cast("string").alias("CustomerID"),
        product.cast("string").alias("ProductID"),
        F.when(_every(key, 43, 3), "1998-13-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("OrderDate"),
        F.when(_every(key, 31, 4), "0").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("Quantity"),
        F.when(_every(key, 37, 5), "").otherwise(_money("l_extendedprice")).alias("UnitPrice"),
        F.when(_every(key, 41, 6), "unknown").otherwise(store).alias("StoreCode"),
    )


def monthly_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of seven currencies for every month with orders, NULL where one is absent."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("RateDate")
    months = table(spark, folder, "orders").select(month).distinct()
    m = (F.year("RateDate") - 1995) * 12 + F.month("RateDate") - 1
    micros = [
        500_000 + ((m * 7 + i * 13) % 89) * 1_000_000 + 250_000 * i + 1 for i in range(len(RATE_CURRENCIES))
    ]
    rates = [
        F.when((m + i) % 9 != 0, (value.cast("decimal(12,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(12,6)"))
        .alias(f"rates_{name}")
        for i, (name, value) in enumerate(zip(RATE_CURRENCIES, micros))
    ]
    return months.select("RateDate", *rates)


def exchange_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly rates as clean rows, absent ones left out."""
    wide = monthly_rates(spark, folder)
    names = [f"rates_{c}" for c in RATE_CURRENCIES]
    long = wide.unpivot("RateDate", names, "name", "ExchangeRate").filter("ExchangeRate is not null")
    return long.select(
        F.lit("USD").alias("BaseCurrency"),
        F.substring("name", 7, 3).alias("TargetCurrency"),
        "ExchangeRate",
        "RateDate",
    )


def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    """Clean customer versions: every fourth customer moved on 1998-06-15."""
    key = F.col("c_custkey")
    stamp = lambda text: F.lit(text).cast("timestamp")
    begun, moved = stamp("1994-12-31"), stamp("1998-06-15")
    city = F.col("c_mktsegment")
    first = F.struct(
        city.alias("City"), begun.alias(VALID_FROM), F.when(_every(key, 4, 0), moved).alias(VALID_TO),
        (key % 4 != 0).alias(IS_CURRENT),
    )
    second = F.struct(
        F.lit("MOVED").alias("City"), moved.alias(VALID_FROM), F.lit(None).cast("timestamp").alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
    )
    versions = F.when(_every(key, 4, 0), F.array(first, second)).otherwise(F.array(first))
    return (
        table(spark, folder, "customer")
        .select(key.cast("int").alias("CustomerID"), "c_name", F.explode(versions).alias("version"))
        .select(
            "CustomerID",
            F.split("c_name", "#")[0].alias("FirstName"),
            F.split("c_name", "#")[1].alias("LastName"),
            F.concat(F.lit("c"), F.col("CustomerID").cast("string"), F.lit("@example.com")).alias("Email"),
            F.concat(F.lit("555"), F.lpad(F.col("CustomerID").cast("string"), 7, "0")).alias("Phone"),
            "version.City",
            F.lit("NT").alias("State"),
            f"version.{VALID_FROM}",
            f"version.{VALID_TO}",
            f"version.{IS_CURRENT}",
        )
    )


BATCH_CUT = "2024-01-16"


def user_events(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    """Events as history input: before the cut, or from it on."""
    rows = table(spark, folder, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    cut = F.lit(BATCH_CUT).cast("timestamp")
    return rows.filter(F.col("ts") < cut) if batch == 1 else rows.filter(F.col("ts") >= cut)
