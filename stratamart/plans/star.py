"""Silver tables to the star schema and its aggregates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.calendar import calendar_columns, date_key
from stratamart.functions.measures import cents, exact_sum, sales_measures
from stratamart.names import (
    BASE_CURRENCY,
    GOLD,
    IS_CURRENT,
    REJECTED,
    RUN_ID,
    SALES_MONTH,
    SILVER,
    STORE_CURRENCY,
    VALID_FROM,
    VALID_TO,
)
from stratamart.operators.dedupe import drop_repeats, settle_repeats
from stratamart.operators.keys import dense_surrogate_key
from stratamart.operators.quality import accepted
from stratamart.operators.sizing import MAX_BROADCAST_ROWS, broadcast_within
from stratamart.operators.temporal import as_of_join, point_in_time_join
from stratamart.plans.audit import FAILED, STARTED, SUCCESS, RunLog
from stratamart.sources.tables import TableStore


def store_currencies(spark: SparkSession, currencies: Mapping[str, str] = STORE_CURRENCY) -> DataFrame:
    """The currency of each store as rows."""
    entries = F.create_map(*[F.lit(text) for pair in currencies.items() for text in pair])
    return spark.range(1).select(F.explode(entries).alias("StoreCode", "LocalCurrency"))


def build_dim_customer(history: DataFrame, key_type: str = "int") -> DataFrame:
    """Every version of every customer, numbered by customer and start."""
    rows = history.select(
        "CustomerID", "FirstName", "LastName", "Email", "Phone", "City", "State", VALID_FROM, VALID_TO, IS_CURRENT
    )
    # The columns after the start only settle versions that start together.
    order = ["CustomerID", VALID_FROM, F.col(VALID_TO).asc_nulls_last(), "FirstName", "LastName", "City", "State"]
    return dense_surrogate_key(rows, order, "CustomerSK", key_type)


def build_dim_product(products: DataFrame, key_type: str = "int") -> DataFrame:
    """Latest row of every product, numbered by product."""
    latest = drop_repeats(products, ["ProductID"]).select(
        "ProductID", "ProductName", "Category", "SubCategory", "Brand", "CostPrice"
    )
    return dense_surrogate_key(latest, ["ProductID"], "ProductSK", key_type)


def build_dim_date(orders: DataFrame, day: str = "OrderDate") -> DataFrame:
    """One row per calendar day from the first order to the day after the last."""
    bounds = orders.agg(F.min(day).alias("first"), F.max(day).alias("last")).filter("first is not null")
    days = bounds.select(F.explode(F.sequence("first", F.date_add("last", 1))).alias("day"))
    return days.select([value.alias(name) for name, value in calendar_columns(F.col("day")).items()])


def latest_rates(rates: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """One rate per currency and day against the base; the rate landed last wins."""
    wanted = rates.filter(F.col("BaseCurrency") == base).drop("BaseCurrency")
    return drop_repeats(wanted, ["TargetCurrency", "RateDate"]).select("TargetCurrency", "RateDate", "ExchangeRate")


def build_fact_sales(
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    rates: DataFrame,
    currencies: DataFrame | None = None,
    base: str = BASE_CURRENCY,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    may_overlap: bool | None = None,
    repeats: bool = True,
) -> DataFrame:
    """One row per order: versions that held on its date, last rate by then, measures.

    Orders repeated across batches are settled first, so no later step has to; orders of
    a single batch have none, say so by ``repeats``. Sides
    below Spark's broadcast threshold are broadcast, and then orders that do not repeat
    are not shuffled at all; ``max_broadcast_rows`` bounds the repeated keys, stores and
    rates that are. Pass stored orders, as they are scanned more than once, and as
    ``may_overlap`` what the history behind the customers says of its versions.
    """
    if currencies is None:
        currencies = F.broadcast(store_currencies(orders.sparkSession))
    else:
        currencies = broadcast_within(currencies, max_broadcast_rows)
    products = dim_product.select("ProductID", "ProductSK", "CostPrice")
    rows = orders.drop(REJECTED)
    if repeats:
        rows = settle_repeats(rows, ["OrderID"], max_broadcast_rows)
    rows = rows.select("OrderID", "CustomerID", "ProductID", "OrderDate", "Quantity", "UnitPrice", "StoreCode")
    rows = point_in_time_join(rows, dim_customer, "CustomerID", "OrderDate", ["CustomerSK"], may_overlap=may_overlap)
    rows = rows.join(products, "ProductID", "left")
    rows = rows.join(currencies, "StoreCode", "left")
    rows = rows.withColumn("LocalCurrency", F.coalesce("LocalCurrency", F.lit(base)))
    rows = as_of_join(
        rows, latest_rates(rates, base), {"LocalCurrency": "TargetCurrency"}, "OrderDate", "RateDate",
        ["ExchangeRate"], max_broadcast_rows,
    )
    rows = rows.withColumn("ExchangeRate", F.coalesce("ExchangeRate", F.lit(1.0)))
    measures = sales_measures(
        F.col("Quantity"), F.col("UnitPrice"), F.col("CostPrice"), F.col("ExchangeRate")
    )
    return rows.select(
        "OrderID", date_key(F.col("OrderDate")).alias("DateSK"), "CustomerSK", "ProductSK", "StoreCode",
        "LocalCurrency", "Quantity", "UnitPrice", "ExchangeRate",
        *[value.alias(name) for name, value in measures.items()],
    )


def daily_sales_by_store(
    fact: DataFrame, dim_date: DataFrame, base: str = BASE_CURRENCY, one_row_per_order: bool = False
) -> DataFrame:
    """Orders, quantity, revenue and margin per day and store.

    With ``one_row_per_order``, which holds for :func:`build_fact_sales`, orders are
    counted without the shuffle of every order id that a distinct count needs.
    """
    orders = F.count("OrderID") if one_row_per_order else F.countDistinct("OrderID")
    days = dim_date.select("DateSK", "CalendarDate")
    return (
        fact.join(days, "DateSK", "left")
        .groupBy("CalendarDate", "StoreCode")
        .agg(
            orders.alias("TotalOrders"),
            F.sum("Quantity").alias("TotalQuantity"),
            exact_sum(F.col("LineTotalBaseCurrency")).alias(f"TotalRevenue{base}"),
            exact_sum(F.col("GrossMarginBaseCurrency")).alias(f"TotalMargin{base}"),
        )
    )


def sales_by_category(fact: DataFrame, dim_product: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """Quantity, revenue and margin per category and subcategory.

    Facts are added up per product first, so the product table meets one row per
    product and a best seller is reduced before anything is shuffled.
    """
    per_product = fact.groupBy("ProductSK").agg(
        F.sum("Quantity").alias("quantity"),
        F.sum(cents(F.col("LineTotalBaseCurrency"))).alias("revenue"),
        F.sum(cents(F.col("GrossMarginBaseCurrency"))).alias("margin"),
    )
    return (
        per_product.join(dim_product.select("ProductSK", "Category", "SubCategory"), "ProductSK", "left")
        .groupBy("Category", "SubCategory")
        .agg(
            F.sum("quantity").alias("TotalQuantity"),
            (F.sum("revenue") / 100).alias(f"TotalRevenue{base}"),
            (F.sum("margin") / 100).alias(f"TotalMargin{base}"),
        )
    )


def _silver(store: TableStore, name: str) -> DataFrame:
    return accepted(store.read(SILVER, name))


def _gold_fact(store: TableStore, months: Sequence[int] | None = None) -> DataFrame:
    """Facts with their month, of all orders or of those of some months."""
    orders = _silver(store, "orders")
    if months is not None:
        orders = orders.filter(_month(F.col("OrderDate")).isin(list(months)))
    fact = build_fact_sales(
        orders,
        store.read(GOLD, "dim_customer"),
        store.read(GOLD, "dim_product"),
        _silver(store, "exchange_rates"),
        may_overlap=store.may_overlap(SILVER, "customers"),
    )
    return fact.withColumn(SALES_MONTH, F.floor(F.col("DateSK") / 100).cast("int"))


def _month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


# Gold tables, dimensions before facts before aggregates.
GOLD_BUILDERS: dict[str, Callable[[TableStore], DataFrame]] = {
    "dim_customer": lambda store: build_dim_customer(_silver(store, "customers")),
    "dim_product": lambda store: build_dim_product(_silver(store, "products")),
    "dim_date": lambda store: build_dim_date(_silver(store, "orders")),
    "fact_sales": _gold_fact,
    "agg_daily_sales_by_store": lambda store: daily_sales_by_store(
        store.read(GOLD, "fact_sales"), store.read(GOLD, "dim_date"), one_row_per_order=True
    ),
    "agg_sales_by_category": lambda store: sales_by_category(store.read(GOLD, "fact_sales"), store.read(GOLD, "dim_product")),
}


def build_star(store: TableStore, run_id: str, only: Iterable[str] | None = None) -> dict[str, int]:
    """Rebuild Gold tables from Silver and return their rows; a failure is logged and raised at once.

    ``only`` names the tables to rebuild; they are built in the order they depend on each
    other, from those that stand already.
    """
    wanted = set(GOLD_BUILDERS if only is None else only)
    if unknown := wanted.difference(GOLD_BUILDERS):
        raise KeyError(f"no Gold tables {sorted(unknown)}")
    rows: dict[str, int] = {}
    with RunLog(store, run_id, GOLD) as log:
        for name in [n for n in GOLD_BUILDERS if n in wanted]:
            log.add(name, STARTED)
            try:
                written = Observation()
                built = GOLD_BUILDERS[name](store).observe(written, F.count(F.lit(1)).alias("rows"))
                parts = [SALES_MONTH] if name == "fact_sales" else []
                store.write(built, GOLD, name, "overwrite", partition_by=parts)
                rows[name] = written.get["rows"]
                log.add(name, SUCCESS, records_out=rows[name])
            except Exception as error:
                log.add(name, FAILED, error=str(error))
                raise
    return rows


def refresh_facts(store: TableStore, run_id: str) -> list[int]:
    """Rebuild the facts of the months that got orders in this run, against the dimensions that stand; returns the months.

    Facts of other months are not touched. Rebuild all with :func:`build_star` once
    dimensions were rebuilt, as that numbers their rows anew.
    """
    arrived = _silver(store, "orders").filter(F.col(RUN_ID) == run_id)
    months = sorted(r[0] for r in arrived.select(_month(F.col("OrderDate"))).distinct().collect())
    with RunLog(store, run_id, GOLD) as log:
        log.add("fact_sales", STARTED)
        try:
            if months:
                written = Observation()
                facts = _gold_fact(store, months).observe(written, F.count(F.lit(1)).alias("rows"))
                store.replace_partitions(facts.hint("rebalance", F.col(SALES_MONTH)), GOLD, "fact_sales")
            log.add("fact_sales", SUCCESS, records_out=written.get["rows"] if months else 0)
        except Exception as error:
            log.add("fact_sales", FAILED, error=str(error))
            raise
    return months
