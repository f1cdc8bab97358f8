"""Two runs over raw files: seed, then an increment."""

import os
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from stratamart.names import AUDIT, BRONZE, GOLD, GOLD_TABLES, INGESTED_AT, IS_CURRENT, RAW, SILVER
from stratamart.plans.audit import get_mark, run_summary
from stratamart.plans.landing import LayerFailed, land_all
from stratamart.plans.publishing import save_all_to_catalog
from stratamart.plans.refining import refine_all
from stratamart.plans.star import build_star, refresh_facts
from stratamart.sources.tables import TableStore
from stratamart.spec import REGISTRY, DatasetSpec

PRODUCTS = "ProductID,ProductName,Category,SubCategory,Brand,CostPrice\n"
CUSTOMERS = "CustomerID,FirstName,LastName,Email,Phone,City,State,LastUpdated\n"
ORDERS = "OrderID,CustomerID,ProductID,OrderDate,Quantity,UnitPrice,StoreCode\n"


def put(store, dataset, name, text, at=None):
    folder = store.path(RAW, dataset)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write(text)
    if at:
        os.utime(f"{folder}/{name}", (at, at))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("lake")))
    put(store, "products", "p1.csv", PRODUCTS + "1,Old,Home,Light,Acme,1.00\n", 1_000_000)
    put(store, "products", "p2.csv", PRODUCTS + "1,Lamp,home,Light,Acme,$10.00\n2,Rug,HOME,,Acme,5.00\n3,Sofa,Home,Seat,Acme,20.00\n3,Sofa,Home,Seat,Acme,20.00\n", 2_000_000)
    put(
        store,
        "customers",
        "c1.csv",
        CUSTOMERS
        + "1,Ann,A,a@x,(555)123-4567,Pune,mh,2024-01-01 08:00:00\n"
        + "2,Bob,B,b@x,5551234567,Goa,GA,2024-01-01 08:00:00\n"
        + "3,Cy,C,,5551234567,Goa,GA,2024-01-01 08:00:00\n",
    )
    put(store, "exchange_rates", "r1.json", '{"amount": 1.0, "base": "USD",\n "date": "2024-01-01", "rates": {"EUR": 0.5, "GBP": 0.25}}')
    put(
        store,
        "orders",
        "o1.csv",
        ORDERS
        + "1,1,1,2024-02-01,2,30.00,ST001\n2,1,3,2024-07-01,1,50.00,ST003\n3,2,1,2024-02-01,0,30.00,ST001\n"
        + "4,9,1,2024-02-01,1,30.00,ST001\n5,2,2,2024-02-01,1,30.00,ST001\n5,2,2,2024-02-01,1,30.00,ST001\n",
    )
    first = (land_all(store, "run-1"), refine_all(store, "run-1"))
    put(store, "customers", "c2.csv", CUSTOMERS + "1,Ann,A,a@x,5551234567,Delhi,DL,2024-06-01 08:00:00\n2,Bob,B,b@x,5551234567,Goa,GA,2024-06-01 08:00:00\n")
    put(store, "exchange_rates", "r2.json", '{"amount": 1.0, "base": "USD", "date": "2024-05-01", "rates": {"EUR": 2.0, "JPY": 100}}')
    put(store, "orders", "o2.csv", "StoreCode,OrderID,CustomerID,ProductID,OrderDate,Quantity,UnitPrice,Channel\nST001,6,2,3,2024-08-01,1,40.00,web\n")
    second = (land_all(store, "run-2"), refine_all(store, "run-2"))
    build_star(store, "run-2")
    return store, first, second


def test_landed_and_refined_counts(lake):
    _, (landed, refined), (landed_again, refined_again) = lake
    assert landed == {"products": 4, "customers": 3, "exchange_rates": 1, "orders": 6}
    assert landed_again == {"products": 0, "customers": 2, "exchange_rates": 1, "orders": 1}
    counts = {n: (r.records_in, r.records_out, r.records_rejected) for n, r in refined.items()}
    assert counts == {"products": (4, 2, 1), "customers": (3, 2, 1), "exchange_rates": (1, 2, 0), "orders": (6, 2, 3)}
    counts = {n: (r.records_in, r.records_out, r.records_rejected) for n, r in refined_again.items()}
    assert counts["customers"] == (2, 1, 0) and counts["orders"] == (1, 1, 0)
    # The table knows three currencies by now; the one this document lacks has no rate.
    assert counts["exchange_rates"] == (1, 2, 1) and counts["products"] == (4, 2, 1)


def test_bronze_is_text_with_audit_columns(lake):
    bronze = lake[0].read(BRONZE, "orders")
    assert {"_SourceFile", "_AdfPipelineRunId", INGESTED_AT} <= set(bronze.columns)
    assert dict(bronze.dtypes)["Quantity"] == "string" and "Channel" in bronze.columns


def test_only_the_newest_full_refresh_file_is_loaded_but_all_are_registered(lake):
    store = lake[0]
    assert store.read(BRONZE, "products").filter("ProductName = 'Old'").count() == 0
    assert store.read(AUDIT, "bronze_file_registry").filter("dataset = 'products'").count() == 2


def test_marks_stand_at_the_last_landing(lake):
    store = lake[0]
    newest = store.read(BRONZE, "orders").agg(F.unix_micros(F.max(INGESTED_AT))).first()[0]
    assert get_mark(store, "orders") == newest and get_mark(store, "products") is None


def test_incremental_reads_prune_landing_dates(lake):
    from stratamart.plans.refining import _not_yet_refined

    waiting = _not_yet_refined(lake[0], REGISTRY["orders"])
    plan = waiting._jdf.queryExecution().executedPlan().toString()
    assert waiting.count() == 0 and "PartitionFilters: [isnotnull(_IngestionDate" in plan


def test_history(lake):
    versions = lake[0].read(SILVER, "customers")
    assert sorted((r.CustomerID, r.City, r[IS_CURRENT]) for r in versions.collect()) == [(1, "Delhi", True), (1, "Pune", False), (2, "Goa", True)]
    assert versions.filter(IS_CURRENT).groupBy("CustomerID").count().filter("count > 1").count() == 0


def test_new_columns_reach_silver(lake):
    rows = {r.OrderID: r.Channel for r in lake[0].read(SILVER, "orders").collect()}
    assert rows == {1: None, 2: None, 6: "web"}


def test_rejects_carry_their_run(lake):
    rejects = lake[0].read(SILVER, "products_rejected_records")
    assert sorted(r["_AdfPipelineRunId"] for r in rejects.collect()) == ["run-1", "run-2"]
    assert {r.OrderID for r in lake[0].read(SILVER, "orders_rejected_records").collect()} == {3, 4, 5}


def test_gold(lake):
    store = lake[0]
    fact = {r.OrderID: r for r in store.read(GOLD, "fact_sales").collect()}
    cities = {r.CustomerSK: r.City for r in store.read(GOLD, "dim_customer").collect()}
    assert {n: cities[r.CustomerSK] for n, r in fact.items()} == {1: "Pune", 2: "Delhi", 6: "Goa"}
    assert (fact[2].LocalCurrency, fact[2].ExchangeRate, fact[2].LineTotalBaseCurrency) == ("EUR", 2.0, 25.0)
    assert sorted(r.ProductSK for r in store.read(GOLD, "dim_product").collect()) == [1, 2]
    assert store.read(GOLD, "dim_date").count() == (date(2024, 8, 2) - date(2024, 2, 1)).days + 1
    daily = store.read(GOLD, "agg_daily_sales_by_store")
    assert daily.agg(F.sum("TotalOrders")).first()[0] == 3 and daily.count() == 3
    assert store.read(GOLD, "agg_sales_by_category").agg(F.sum("TotalQuantity")).first()[0] == 4


def test_execution_log(lake):
    summary = run_summary(lake[0].read(AUDIT, "pipeline_execution_log"))
    assert summary.filter("final_status <> 'SUCCESS'").count() == 0
    assert summary.filter("layer = 'gold'").count() == len(GOLD_TABLES)


def test_catalog_publishing(lake, spark, tmp_path):
    store = lake[0]
    save_all_to_catalog(store, "run-2", "published", location=str(tmp_path / "db"))
    assert spark.table("published.fact_sales").count() == 3
    with pytest.raises(LayerFailed, match="no_such_table"):
        save_all_to_catalog(store, "run-2", "published", ["dim_date", "no_such_table"])
    assert spark.table("published.dim_date").count() == store.read(GOLD, "dim_date").count()


def test_nothing_new_changes_nothing(lake):
    store = lake[0]
    before = store.read(SILVER, "orders").count()
    assert set(land_all(store, "run-3").values()) == {0}
    assert {n: r.records_in for n, r in refine_all(store, "run-3").items() if n != "products"} == {"customers": 0, "exchange_rates": 0, "orders": 0}
    assert store.read(SILVER, "orders").count() == before


def test_gold_tables_one_by_one(lake):
    store = lake[0]
    assert build_star(store, "run-4", only=["agg_sales_by_category", "dim_date"]) == {"dim_date": store.read(GOLD, "dim_date").count(), "agg_sales_by_category": 2}
    with pytest.raises(KeyError, match="no_such"):
        build_star(store, "run-4", only=["no_such"])
    log = store.read(AUDIT, "pipeline_execution_log").filter("pipeline_run_id = 'run-4'")
    assert sorted((r.dataset, r.status) for r in log.collect()) == [
        (name, status) for name in ("agg_sales_by_category", "dim_date") for status in ("STARTED", "SUCCESS")
    ]


def test_facts_of_changed_months_are_rebuilt(lake, explained):
    """Runs last, as it adds an order."""
    store = lake[0]

    def files(month):
        return {r[0] for r in store.read(GOLD, "fact_sales").filter(f"_SalesMonth = {month}").select(F.input_file_name()).collect()}

    february, july = files(202402), files(202407)
    assert february and july and refresh_facts(store, "nothing") == []
    put(store, "orders", "o9.csv", ORDERS + "70,1,1,2024-07-20,3,10.00,ST001\n")
    land_all(store, "run-9", {"orders": REGISTRY["orders"]})
    refine_all(store, "run-9", {"orders": REGISTRY["orders"]})
    assert refresh_facts(store, "run-9") == [202407]
    assert files(202402) == february and not files(202407) & july
    assert sorted(r.OrderID for r in store.read(GOLD, "fact_sales").collect()) == [1, 2, 6, 70]
    plan = explained(store.read(GOLD, "fact_sales").filter("_SalesMonth = 202407"))
    assert re.search(r"PartitionFilters: .*_SalesMonth#\d+ = 202407", plan) and re.search(r"PartitionFilters: .*_snapshot#\d+ = ", plan)


def test_failures_are_collected_and_raised_at_the_end(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    put(store, "bad", "b.csv", "a\n1\n")
    put(store, "good", "g.csv", "a\n1\n")
    registry = {"bad": DatasetSpec("bad", {"a": "int"}, reject_when=("nonsense(",)), "good": DatasetSpec("good", {"a": "int"})}
    land_all(store, "r", registry)
    with pytest.raises(LayerFailed, match="bad"):
        refine_all(store, "r", registry)
    assert store.read(SILVER, "good").count() == 1
    assert store.read(AUDIT, "pipeline_execution_log").filter("status = 'FAILED' and dataset = 'bad'").count() == 1


def test_registry_order_puts_references_first():
    names = list(REGISTRY)
    for name, spec in REGISTRY.items():
        assert all(names.index(check.table) < names.index(name) for check in spec.references)
