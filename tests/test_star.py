from datetime import date, datetime
from decimal import Decimal

import pytest

from stratamart.operators import change_batches
from stratamart.plans.star import (
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    build_fact_sales,
    daily_sales_by_store,
    sales_by_category,
)
from pyspark.sql import functions as F

JAN, JUN = datetime(2024, 1, 1), datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def star(spark):
    history = spark.createDataFrame(
        [
            (1, "Al", "A", "a@x", "5551234567", "Pune", "MH", JAN, JUN, False),
            (1, "Al", "A", "a@x", "5551234567", "Delhi", "DL", JUN, None, True),
            (2, "Bo", "B", "b@x", "5551234568", "Goa", "GA", JAN, None, True),
        ],
        "CustomerID int, FirstName string, LastName string, Email string, Phone string, City string, State string, "
        "_SCD_EffectiveStartDate timestamp, _SCD_EffectiveEndDate timestamp, _SCD_IsCurrent boolean",
    )
    products = spark.createDataFrame(
        [(102, "Rug", "Home", "Floor", "Acme", Decimal("10.00")), (101, "Lamp", "Home", "Light", "Acme", Decimal("100.00")), (101, "Lamp", "Home", "Light", "Acme", Decimal("100.00"))],
        "ProductID int, ProductName string, Category string, SubCategory string, Brand string, CostPrice decimal(10,2)",
    )
    rates = spark.createDataFrame(
        [("USD", "EUR", Decimal("0.5"), date(2024, 3, 1)), ("USD", "EUR", Decimal("2.0"), date(2024, 7, 1)), ("EUR", "EUR", Decimal("9.0"), date(2024, 3, 2))],
        "BaseCurrency string, TargetCurrency string, ExchangeRate decimal(12,6), RateDate date",
    )
    orders = spark.createDataFrame(
        [
            (1001, 1, 101, date(2024, 3, 15), 2, Decimal("1200.00"), "ST001"),
            (1002, 2, 102, date(2024, 3, 15), 1, Decimal("300.00"), "ST001"),
            (1003, 1, 101, date(2024, 6, 1), 3, Decimal("10.00"), "ST003"),
            (1003, 1, 101, date(2024, 6, 1), 3, Decimal("10.00"), "ST003"),
            (1004, 1, 999, date(2023, 1, 1), 1, Decimal("7.00"), "ST999"),
        ],
        "OrderID bigint, CustomerID int, ProductID int, OrderDate date, Quantity int, UnitPrice decimal(10,2), StoreCode string",
    )
    customers, catalogue = build_dim_customer(history), build_dim_product(products)
    return orders, customers, catalogue, rates


def test_customer_keys(star):
    assert [(r.CustomerSK, r.CustomerID, r.City) for r in star[1].orderBy("CustomerSK").collect()] == [(1, 1, "Pune"), (2, 1, "Delhi"), (3, 2, "Goa")]


def test_product_keys(star):
    assert [(r.ProductSK, r.ProductID) for r in star[2].orderBy("ProductSK").collect()] == [(1, 101), (2, 102)]


@pytest.mark.parametrize("bound", [500_000, 0])
def test_fact(star, rows, bound):
    fact = build_fact_sales(*star, max_broadcast_rows=bound)
    shown = rows(fact, "OrderID", "CustomerSK", "ProductSK", "LocalCurrency", "ExchangeRate", "LineTotalBaseCurrency", "LineCostBaseCurrency", "GrossMarginBaseCurrency")
    assert shown == [
        (1001, 1, 1, "USD", 1.0, 2400.0, 200.0, 2200.0),
        (1002, 3, 2, "USD", 1.0, 300.0, 10.0, 290.0),
        (1003, 2, 1, "EUR", 0.5, 60.0, 600.0, -540.0),
        (1004, None, None, "USD", 1.0, 7.0, None, None),
    ]
    assert dict(fact.dtypes)["DateSK"] == "int" and dict(fact.dtypes)["LineTotalLocal"] == "decimal(21,2)"


def test_dates_run_to_the_day_after(star, spark):
    days = build_dim_date(star[0])
    assert days.count() == (date(2024, 6, 2) - date(2023, 1, 1)).days + 1
    assert days.agg(F.max("CalendarDate")).first()[0] == "2024-06-02"
    assert build_dim_date(star[0].filter("false")).count() == 0


def test_aggregates(star, rows):
    fact = build_fact_sales(*star)
    days = build_dim_date(star[0])
    for unique in (True, False):
        daily = {(r.CalendarDate, r.StoreCode): r for r in daily_sales_by_store(fact, days, one_row_per_order=unique).collect()}
        assert len(daily) == 3
        march = daily[("2024-03-15", "ST001")]
        assert (march.TotalOrders, march.TotalQuantity, march.TotalRevenueUSD, march.TotalMarginUSD) == (2, 3, 2700.0, 2490.0)
    assert rows(sales_by_category(fact, star[2])) == sorted(
        [("Home", "Light", 5, 2460.0, 1660.0), ("Home", "Floor", 1, 300.0, 290.0), (None, None, 1, 7.0, None)], key=repr
    )


def test_change_batches(spark, rows):
    base = spark.createDataFrame([(i, f"n{i}") for i in range(1, 11)], "id int, name string")
    batch = change_batches.change_batch(base, "id", F.col("id") <= 2, {"name": F.lit("moved")}, base.filter("id > 8"), ["name"])
    assert rows(batch) == sorted([(1, "moved"), (2, "moved"), (11, "n10"), (12, "n9")], key=repr)
    assert change_batches.next_key(base.filter("false"), "id") == 1
    assert change_batches.full_snapshot(base, batch).count() == 14
    texts = spark.createDataFrame([("10",), ("9",), ("10",)], "id string")
    assert [r.id for r in change_batches.key_pool(texts, "id").collect()] == ["9", "10"]
    assert change_batches.repeat_rows(base, F.col("id") == 3).count() == 11


def test_chosen_rows_are_stable(spark):
    ids = spark.range(20000).repartition(3)
    picked = ids.filter(change_batches.chosen(F.col("id"), 0.06, "s"))
    again = ids.repartition(7).filter(change_batches.chosen(F.col("id"), 0.06, "s"))
    assert picked.exceptAll(again).count() == 0 and 1000 < picked.count() < 1400


def test_rate_documents(spark, rows):
    rates = spark.createDataFrame([("EUR", 0.5, date(2024, 1, 1)), ("JPY", None, date(2024, 1, 1))], "TargetCurrency string, ExchangeRate double, RateDate date")
    assert rows(change_batches.rate_documents(rates), "document") == [('{"amount":1.0,"base":"USD","date":"2024-01-01","rates":{"EUR":0.5}}',)]
