"""Registered queries: each runs library operators over whole analytics tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.names import (
    AUDIT,
    BASE_CURRENCY,
    BRONZE,
    EXECUTION_LOG,
    GOLD,
    INGESTED_AT,
    IS_CURRENT,
    PROCESSED_AT,
    RAW,
    RECORD_HASH,
    REJECTED,
    REJECTS_SUFFIX,
    RUN_ID,
    SILVER,
    SOURCE_FILE,
    VALID_FROM,
    VALID_TO,
    WATERMARKS,
)
from stratamart.functions.cleaning import scrub, scrub_phone
from stratamart.functions.hashing import record_hash
from stratamart.functions.measures import exact_sum
from stratamart.operators import change_batches
from stratamart.operators.dedupe import drop_repeats
from stratamart.operators.nested import flatten, parse_payload, wide_to_long
from stratamart.operators.projection import (
    add_landing_audit,
    add_missing,
    add_processing_audit,
    all_as_strings,
    drop_technical,
)
from stratamart.operators.quality import (
    accepted,
    cast_columns,
    clean_and_flag,
    flag_nulls,
    flag_orphans,
    rejected,
)
from stratamart.operators.scd2 import fold_batch
from stratamart.operators.temporal import as_of_join, current_version_join, point_in_time_join
from stratamart.plans import audit, samples
from stratamart.plans.landing import LayerFailed, land_all
from stratamart.plans.publishing import save_all_to_catalog
from stratamart.plans.refining import refine_all, reshape
from stratamart.plans.star import (
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    build_fact_sales,
    build_star,
    daily_sales_by_store,
    sales_by_category,
    store_currencies,
)
from stratamart.session import new_work_folder, stored
from stratamart.sources.exports import preview, save_to_catalog, write_csv, write_json_documents
from stratamart.sources.files import (
    above_mark,
    csv_headers,
    list_files,
    new_files,
    newest,
    read_csv,
    read_csv_folder,
    read_json_documents,
    read_mixed_csv,
    register_files,
    rows_of,
)
from stratamart.sources.tables import TableStore
from stratamart.spec import CUSTOMERS, EXCHANGE_RATES, ORDERS, PRODUCTS, DatasetSpec, History, RefCheck
from stratamart.streaming.files import land_stream, refine_history_stream

USER_HISTORY = History(key="user_id", tracked=("event_type",), effective="ts")

_AS_NTZ = "timestamp_ntz"


# --- cleaning and validation -------------------------------------------------


def dedupe_orders(spark: SparkSession, folder: str) -> DataFrame:
    lines = samples.keyed_lines(spark, folder).select(F.col("id").alias("OrderID"), *samples.LINE_ORDER)
    return drop_repeats(lines, ["OrderID"], [F.col(c).asc() for c in samples.LINE_ORDER])


def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    products = samples.raw_products(spark, folder)
    return drop_repeats(change_batches.repeat_rows(products, F.col("ProductID").cast("bigint") % 50 == 0))


def flagged_products(spark: SparkSession, folder: str) -> DataFrame:
    return clean_and_flag(samples.raw_products(spark, folder), PRODUCTS)


def flagged_customers(spark: SparkSession, folder: str) -> DataFrame:
    return clean_and_flag(samples.raw_customers(spark, folder), CUSTOMERS)


def _order_references(
    spark: SparkSession, folder: str, products: DataFrame
) -> Callable[[RefCheck], DataFrame | None]:
    customers = samples.table(spark, folder, "customer").select(F.col("c_custkey").cast("int").alias("CustomerID"))
    tables = {"customers": customers, "products": products}
    return lambda check: tables.get(check.table)


def flagged_orders(spark: SparkSession, folder: str, products: DataFrame | None = None) -> DataFrame:
    products = clean_products(spark, folder) if products is None else products
    return clean_and_flag(samples.raw_orders(spark, folder), ORDERS, _order_references(spark, folder, products))


def clean_products(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(flagged_products(spark, folder))


def rejects_products(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(flagged_products(spark, folder))


def clean_customers(spark: SparkSession, folder: str) -> DataFrame:
    return flagged_customers(spark, folder).withColumn("LastUpdated", F.col("LastUpdated").cast(_AS_NTZ))


def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    return flagged_orders(spark, folder)


def ref_integrity_orders(spark: SparkSession, folder: str) -> DataFrame:
    raw = samples.raw_orders(spark, folder)
    orders = cast_columns(raw, ORDERS)
    lookup = _order_references(spark, folder, clean_products(spark, folder))
    for check in ORDERS.references:
        flag = f"{check.column}_orphan"
        orders = flag_orphans(orders, check.column, lookup(check), check.ref_column, flag)
    return orders.groupBy("CustomerID_orphan", "ProductID_orphan").agg(F.count("*").alias("order_count"))


def phone_scrub(spark: SparkSession, folder: str) -> DataFrame:
    rows = samples.raw_customers(spark, folder)
    return rows.select("CustomerID", F.col("Phone").alias("RawPhone"), scrub_phone(scrub(F.col("Phone"))).alias("Phone"))


def null_flags(spark: SparkSession, folder: str) -> DataFrame:
    products = cast_columns(samples.raw_products(spark, folder), PRODUCTS)
    return flag_nulls(products, ["SubCategory", "Brand", "NoSuchColumn"]).select("ProductID", REJECTED)


def record_hashes(spark: SparkSession, folder: str) -> DataFrame:
    rows = cast_columns(samples.raw_customers(spark, folder), CUSTOMERS)
    return rows.select("CustomerID", record_hash(CUSTOMERS.history.tracked).alias(RECORD_HASH))


def record_hashes_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Hashes that tell apart all rows: values carry their lengths."""
    rows = cast_columns(samples.raw_customers(spark, folder), CUSTOMERS)
    return rows.select("CustomerID", record_hash(CUSTOMERS.history.tracked, unambiguous=True).alias(RECORD_HASH))


# --- nested data -------------------------------------------------------------


def flatten_events(spark: SparkSession, folder: str) -> DataFrame:
    events = samples.table(spark, folder, "events")
    parsed = events.select(
        F.struct("event_id", F.struct("user_id", "event_type").alias("actor")).alias("event"),
        F.from_json("props", "k int").alias("props"),
    )
    return flatten(parsed)


def payload_keys(spark: SparkSession, folder: str) -> DataFrame:
    payloads = samples.table(spark, folder, "events").select(F.col("props").alias("raw_payload"))
    return parse_payload(payloads, {"k": "payload_key"}).groupBy("payload_key").agg(F.count("*").alias("event_count"))


def flatten_lines(spark: SparkSession, folder: str) -> DataFrame:
    def amount(kind: str, column: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value"))

    lines = samples.table(spark, folder, "lineitem").select(
        F.struct(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("number")).alias("line"),
        F.array(amount("price", "l_extendedprice"), amount("tax", "l_tax"), amount("discount", "l_discount")).alias("amounts"),
    )
    return flatten(lines)


def unpivot_rates(spark: SparkSession, folder: str) -> DataFrame:
    wide = samples.monthly_rates(spark, folder).select(
        F.date_format("RateDate", "yyyy-MM-dd").alias("date"),
        F.lit(BASE_CURRENCY).alias("base"),
        *[f"rates_{c}" for c in samples.RATE_CURRENCIES],
    )
    return wide_to_long(wide, EXCHANGE_RATES.wide_to_long)


# --- history and time --------------------------------------------------------


def _versions_for_report(rows: DataFrame) -> DataFrame:
    return rows.select(
        "user_id",
        "event_type",
        RECORD_HASH,
        F.col(VALID_FROM).cast(_AS_NTZ).alias(VALID_FROM),
        F.col(VALID_TO).cast(_AS_NTZ).alias(VALID_TO),
        IS_CURRENT,
    )


def scd2_first_load(spark: SparkSession, folder: str) -> DataFrame:
    everything = samples.user_events(spark, folder, 1).unionByName(samples.user_events(spark, folder, 2))
    return _versions_for_report(fold_batch(None, everything, USER_HISTORY))


def scd2_users(spark: SparkSession, folder: str) -> DataFrame:
    first = fold_batch(None, samples.user_events(spark, folder, 1), USER_HISTORY)
    return _versions_for_report(fold_batch(first, samples.user_events(spark, folder, 2), USER_HISTORY))


def scd2_table(spark: SparkSession, folder: str) -> DataFrame:
    store = TableStore(spark, new_work_folder(spark, "scd2"))
    for batch in (1, 2):
        store.upsert_history(samples.user_events(spark, folder, batch), SILVER, "users", USER_HISTORY, f"run-{batch}")
    return _versions_for_report(store.read(SILVER, "users"))


_BATCH_CUTS = ("2024-01-08", "2024-01-16", "2024-01-24")


def _event_batches(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Events as four batches of history input, in the order of their time."""
    rows = samples.table(spark, folder, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    cuts = [F.lit(c).cast("timestamp") for c in _BATCH_CUTS]
    number = sum((F.coalesce(F.col("ts") >= cut, F.lit(False)).cast("int") for cut in cuts), F.lit(0))
    return [rows.filter(number == k) for k in range(len(cuts) + 1)]


def scd2_many_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A history table in buckets over four batches; the second one comes again after the third."""
    store = TableStore(spark, new_work_folder(spark, "buckets"))
    batches = _event_batches(spark, folder)
    for number in (0, 1, 2, 1, 3):
        store.upsert_history(batches[number], SILVER, "users", USER_HISTORY, f"run-{number}", buckets=8, batch_number=("events", number))
    return _versions_for_report(store.read(SILVER, "users"))


def late_closures(spark: SparkSession, folder: str) -> DataFrame:
    """Batches folded newest first, so that the older one arrives late."""
    first = fold_batch(None, samples.user_events(spark, folder, 2), USER_HISTORY)
    late = fold_batch(first, samples.user_events(spark, folder, 1), USER_HISTORY)
    return audit.closed_before_start(late, VALID_FROM, VALID_TO)


_AWAY = (("1995-03-01", "1995-09-01"), ("1998-06-01", "1998-07-01"))


def _dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    return samples.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").cast("int").alias("CustomerID"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
    )


def pit_customer(spark: SparkSession, folder: str) -> DataFrame:
    history = samples.customer_history(spark, folder)
    return point_in_time_join(_dated_orders(spark, folder), history, "CustomerID", "OrderDate", ["City"], may_overlap=False)


def pit_periods(spark: SparkSession, folder: str) -> DataFrame:
    """The same by customer and year, as for customers with very many versions."""
    history = samples.customer_history(spark, folder)
    orders = _dated_orders(spark, folder)
    return point_in_time_join(orders, history, "CustomerID", "OrderDate", ["City"], may_overlap=False, period_days=365)


def pit_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """Every third customer was away for spans within other versions; every fifth order comes twice."""
    history = samples.customer_history(spark, folder).select("CustomerID", "City", VALID_FROM, VALID_TO)
    away = [F.struct(F.lit(a).cast("timestamp").alias("a"), F.lit(b).cast("timestamp").alias("b")) for a, b in _AWAY]
    late = (
        samples.table(spark, folder, "customer").where("c_custkey % 3 = 0")
        .select(F.col("c_custkey").cast("int").alias("CustomerID"), F.explode(F.array(*away)).alias("s"))
        .select("CustomerID", F.lit("AWAY").alias("City"), F.col("s.a").alias(VALID_FROM), F.col("s.b").alias(VALID_TO))
    )
    orders = change_batches.repeat_rows(_dated_orders(spark, folder), F.col("OrderID") % 5 == 0)
    return point_in_time_join(orders, history.unionByName(late), "CustomerID", "OrderDate", ["City"], may_overlap=True)


def current_customer(spark: SparkSession, folder: str) -> DataFrame:
    history = samples.customer_history(spark, folder)
    return current_version_join(_dated_orders(spark, folder), history, "CustomerID", ["City"])


def _converted(spark: SparkSession, folder: str, **how) -> DataFrame:
    store = F.concat(F.lit("ST"), F.lpad((F.col("CustomerID") % 10 + 1).cast("string"), 3, "0"))
    orders = _dated_orders(spark, folder).withColumn("StoreCode", store)
    orders = orders.join(F.broadcast(store_currencies(spark)), "StoreCode", "left")
    rates = samples.exchange_rates(spark, folder).select("TargetCurrency", "RateDate", "ExchangeRate")
    joined = as_of_join(orders, rates, {"LocalCurrency": "TargetCurrency"}, "OrderDate", "RateDate", ["ExchangeRate"], **how)
    return joined.select("OrderID", "LocalCurrency", "OrderDate", F.coalesce("ExchangeRate", F.lit(1.0)).alias("ExchangeRate"))


def asof_fx(spark: SparkSession, folder: str) -> DataFrame:
    return _converted(spark, folder)


def asof_fx_periods(spark: SparkSession, folder: str) -> DataFrame:
    """The same by currency and period, as for series whose days are too many to broadcast."""
    return _converted(spark, folder, max_broadcast_rows=0)


# --- star schema -------------------------------------------------------------


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    rows = build_dim_customer(samples.customer_history(spark, folder))
    return rows.withColumns({c: F.col(c).cast(_AS_NTZ) for c in (VALID_FROM, VALID_TO)})


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return build_dim_product(accepted(flagged_products(spark, folder)))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return build_dim_date(samples.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("OrderDate")))


def _sales(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The fact table and the product dimension it refers to."""
    # The dimension holds the accepted products, so it also serves the reference check.
    products = dim_product(spark, folder)
    fact = build_fact_sales(
        stored(accepted(flagged_orders(spark, folder, products)), "orders"),
        build_dim_customer(samples.customer_history(spark, folder)),
        products,
        samples.exchange_rates(spark, folder),
        may_overlap=False,
        repeats=False,
    )
    return fact, products


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _sales(spark, folder)[0]


def agg_daily_store(spark: SparkSession, folder: str) -> DataFrame:
    return daily_sales_by_store(fact_sales(spark, folder), dim_date(spark, folder), one_row_per_order=True)


def agg_category(spark: SparkSession, folder: str) -> DataFrame:
    return sales_by_category(*_sales(spark, folder))


def revenue_total(spark: SparkSession, folder: str) -> DataFrame:
    lines = samples.table(spark, folder, "lineitem")
    return lines.agg(
        F.sum(F.col("l_extendedprice").cast("decimal(28,2)")).cast("double").alias("total_price"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity"),
    )


# --- files, tables and streams -----------------------------------------------


def _raw_orders_by_year(spark: SparkSession, folder: str, where: str, label: str) -> str:
    """Raw orders of some years as CSV files, one folder per year."""
    target = new_work_folder(spark, label)
    orders = samples.table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    write_csv(orders.filter(where), target, partition_by=["year"])
    return target


def _rows_per_year(raw: DataFrame) -> DataFrame:
    year = F.regexp_extract("_SourceFile", r"year=(\d+)/", 1).cast("int")
    return raw.groupBy(year.alias("order_year")).agg(
        F.count("*").alias("order_count"),
        F.sum(F.col("o_custkey").cast("bigint")).alias("customer_sum"),
        F.max("o_orderpriority").alias("last_priority"),
    )


def landed_csv(spark: SparkSession, folder: str) -> DataFrame:
    target = _raw_orders_by_year(spark, folder, "true", "csv")
    return _rows_per_year(read_csv(spark, target, recursive=True))


def csv_folder(spark: SparkSession, folder: str) -> DataFrame:
    target = _raw_orders_by_year(spark, folder, "true", "folder")
    return read_csv_folder(spark, target).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


def unregistered_files(spark: SparkSession, folder: str) -> DataFrame:
    """Years after 1997 arrive after the earlier ones were registered; only they are read."""
    store = TableStore(spark, new_work_folder(spark, "registry"))
    raw = store.path(RAW, "orders")
    rows = samples.table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderkey", "o_custkey", "o_orderpriority"
    )
    write_csv(rows.filter("year <= 1997"), f"{raw}/early", partition_by=["year"])
    register_files(store, "orders", new_files(store, "orders", raw), "run-1")
    write_csv(rows.filter("year > 1997"), f"{raw}/late", partition_by=["year"])
    fresh = stored(new_files(store, "orders", raw), "new-files")
    oldest = fresh.agg(F.unix_micros(F.min("modificationTime"))).first()[0]
    return _rows_per_year(rows_of(read_csv(spark, raw, recursive=True, oldest=oldest), fresh))


def mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of each year in another order of columns, one year without priorities, matched by name."""
    target = new_work_folder(spark, "headers")
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    orders = samples.table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    for k, year in enumerate(range(1992, 1999)):
        names = columns[k % 3 :] + columns[: k % 3]
        rows = orders.filter(F.col("year") == year if k else F.col("year").isNull() | (F.col("year") <= year))
        write_csv(rows.select(names if year != 1995 else [c for c in names if c != "o_orderpriority"]), f"{target}/{year}")
    files = stored(list_files(spark, target), "files")
    rows = read_mixed_csv(spark, target, files, csv_headers(spark, target, files))
    return rows.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderpriority")


def latest_file(spark: SparkSession, folder: str) -> DataFrame:
    """Two snapshots of prices by brand, a file each; only the newer one is loaded, whatever the names."""
    target = new_work_folder(spark, "newest")
    parts = samples.table(spark, folder, "part")
    for name, rows in (("second", parts.where("p_size <= 25")), ("first", parts)):
        brands = rows.groupBy("p_brand").agg(F.count("*").alias("part_count"), exact_sum(F.col("p_retailprice")).alias("price"))
        write_csv(brands, f"{target}/{name}", single_file=True)
    path = newest(list_files(spark, target)).first()["path"]
    return read_csv(spark, [path]).select("p_brand", F.col("part_count").cast("long"), F.col("price").cast("double"))


def rate_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Rates to JSON documents and back to clean rows."""
    target = new_work_folder(spark, "rates")
    documents = change_batches.rate_documents(samples.exchange_rates(spark, folder))
    write_json_documents(documents, target, F.col("document"), "RateDate")
    raw = read_json_documents(spark, target).withColumn("_IngestionTimestamp", F.current_timestamp())
    flagged = clean_and_flag(reshape(raw, EXCHANGE_RATES), EXCHANGE_RATES)
    return flagged.select("BaseCurrency", "TargetCurrency", "ExchangeRate", "RateDate", REJECTED)


def upsert_watermark(spark: SparkSession, folder: str) -> DataFrame:
    store = TableStore(spark, new_work_folder(spark, "marks"))
    for batch in (1, 2):
        # Users without events in the second batch keep the mark of the first.
        events = samples.user_events(spark, folder, batch)
        marks = events.groupBy(F.col("user_id").cast("string").alias("dataset")).agg(F.max("ts").alias("watermark"))
        store.replace_by_key(marks, AUDIT, WATERMARKS, "dataset")
    return store.read(AUDIT, WATERMARKS).withColumn("watermark", F.col("watermark").cast(_AS_NTZ))


def schema_evolve(spark: SparkSession, folder: str) -> DataFrame:
    store = TableStore(spark, new_work_folder(spark, "evolve"))
    parts = samples.table(spark, folder, "part")
    store.evolve_and_write(parts.filter("p_size <= 25").select("p_partkey", "p_name"), SILVER, "parts")
    store.evolve_and_write(parts.filter("p_size > 25").select("p_partkey", "p_name", "p_brand", "p_size"), SILVER, "parts")
    return store.read(SILVER, "parts")


def partitioned_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table partitioned on write, then appended to and read as a whole."""
    store = TableStore(spark, new_work_folder(spark, "partitions"))
    orders = samples.table(spark, folder, "orders")
    filled = F.col("o_orderstatus").eqNullSafe("F")
    for part in (filled, ~filled):
        store.write(
            orders.filter(part).select("o_orderkey", "o_orderpriority", "o_orderstatus"),
            SILVER, "orders", "append", partition_by=["o_orderpriority"],
        )
    return store.read(SILVER, "orders")


def month_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by month; one month is replaced by corrected rows, then late orders of two months are appended."""
    store = TableStore(spark, new_work_folder(spark, "months"))
    day = F.col("o_orderdate")
    orders = samples.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", (F.year(day) * 100 + F.month(day)).alias("month"))
    late = (F.col("o_orderkey") % 7 == 0) & F.col("month").isin(199506, 199507)
    store.write(orders.filter(~F.coalesce(late, F.lit(False))), SILVER, "orders", partition_by=["month"])
    corrected = store.read(SILVER, "orders").filter("month = 199506").withColumn("o_totalprice", F.lit(0.0))
    store.replace_partitions(corrected, SILVER, "orders")
    store.write(orders.filter(late), SILVER, "orders")
    return store.read(SILVER, "orders")


def evolve_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned table overwritten with a new column, then appended to."""
    store = TableStore(spark, new_work_folder(spark, "overwrite"))
    orders = samples.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    filled = F.col("o_orderstatus").eqNullSafe("F")
    store.write(orders.drop("o_orderstatus"), SILVER, "orders", partition_by=["o_orderpriority"])
    store.evolve_and_write(orders.filter(filled), SILVER, "orders", "overwrite")
    store.evolve_and_write(orders.filter(~filled), SILVER, "orders")
    return store.read(SILVER, "orders")


def incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    events = samples.table(spark, folder, "events")
    return above_mark(events, F.lit("2024-01-16").cast(_AS_NTZ), "ts").select("event_id", "user_id", "event_type", "value")


def catalog_preview(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of previews of catalog tables."""
    location = new_work_folder(spark, "catalog")
    database = "strata_" + location.rsplit("-", 1)[-1][:12]
    counts = []
    for name in ("region", "nation", "customer", "part"):
        save_to_catalog(samples.table(spark, folder, name), database, name, location)
        counts.append(preview(spark, database, name).agg(F.count("*").alias("preview_rows")).select(F.lit(name).alias("table_name"), "preview_rows"))
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def _table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = samples.table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs of the file stream: the second finds the files of the first already landed."""
    work = new_work_folder(spark, "stream")
    for run in ("run-1", "run-2"):
        source = _table_stream(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        land_stream(source, f"{work}/bronze", f"{work}/progress", run)
    return spark.read.parquet(f"{work}/bronze").groupBy("o_orderstatus").agg(
        F.count("*").alias("order_count"), F.sum("o_custkey").alias("customer_sum")
    )


def stream_history(spark: SparkSession, folder: str) -> DataFrame:
    """Type 2 history kept by a stream; the newest event of each user opens its version."""
    work = new_work_folder(spark, "history")
    store = TableStore(spark, work)
    source = _table_stream(spark, folder, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    refine_history_stream(store, source, "users", USER_HISTORY, "run-1", f"{work}/progress")
    return _versions_for_report(store.read(SILVER, "users"))


def stream_history_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Four files of events, a batch of the stream each; a second run of the stream finds none left."""
    work = new_work_folder(spark, "changes")
    store = TableStore(spark, work)
    batches = _event_batches(spark, folder)
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(f"{work}/raw")
    source = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/raw")
    for run in ("run-1", "run-2"):
        refine_history_stream(store, source, "users", USER_HISTORY, run, f"{work}/progress")
    return _versions_for_report(store.read(SILVER, "users"))


# --- audit reports -----------------------------------------------------------


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as an execution log: users are runs, event types are layers."""
    status = F.element_at(F.array(F.lit("STARTED"), F.lit("SUCCESS"), F.lit("FAILED")), (F.col("event_id") % 3 + 1).cast("int"))
    log = samples.table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("pipeline_run_id"),
        F.col("event_type").alias("layer"),
        F.concat(F.lit("dataset-"), (F.col("event_id") % 4).cast("string")).alias("dataset"),
        status.alias("status"),
        F.floor("value").cast("bigint").alias("records_in"),
        F.floor(F.col("value") / 2).cast("bigint").alias("records_out"),
        F.when(F.col("event_id") % 5 == 0, F.lit(1)).cast("bigint").alias("records_rejected"),
        F.col("ts").alias("event_timestamp"),
    )
    return audit.run_summary(log)


def latest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as rejects of thirty runs, one per day."""
    rejects = samples.table(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd")).alias(RUN_ID),
        F.col("ts").alias(PROCESSED_AT),
    )
    return audit.latest_run(rejects).select("event_id", RUN_ID)


def reject_profile(spark: SparkSession, folder: str) -> DataFrame:
    flagged = {
        "products": flagged_products(spark, folder),
        "customers": flagged_customers(spark, folder),
        "orders": flagged_orders(spark, folder),
    }
    profiles = [audit.quality_profile(rows, name) for name, rows in flagged.items()]
    return profiles[0].unionByName(profiles[1]).unionByName(profiles[2])


# --- change batches ----------------------------------------------------------


def dirty_products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    parts = samples.table(spark, folder, "part").select("p_partkey", "p_brand", F.col("p_type").alias("category"))
    return change_batches.corrupt(
        parts, {"p_brand": (key % 17 == 3, F.lit(None)), "category": (key % 13 == 2, F.lower("category"))}
    )


def dirt_share(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that hashed selection makes dirty at the usual ratio, by status, and their share."""
    lines = samples.table(spark, folder, "lineitem")
    picked = change_batches.chosen(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"), 0.06, "price")
    dirty = F.count_if(picked)
    return lines.groupBy("l_linestatus").agg(
        F.count("*").alias("line_count"), dirty.alias("dirty_count"),
        F.sum(F.when(picked, F.col("l_orderkey")).otherwise(0)).cast("long").alias("dirty_keys"),
        F.round(dirty / F.count("*"), 2).alias("dirty_share"),
    )


def repeated_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = samples.table(spark, folder, "orders")
    doubled = change_batches.repeat_rows(orders, F.col("o_orderkey") % 67 == 0)
    return doubled.groupBy("o_orderpriority").agg(F.count("*").alias("order_count"))


def customer_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh customer moves; every tenth is copied as a newcomer."""
    customers = samples.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return change_batches.change_batch(
        customers,
        "c_custkey",
        F.col("c_custkey") % 7 == 0,
        {"c_mktsegment": F.lit("MOVED")},
        customers.filter("c_custkey % 10 = 0"),
        ["c_name"],
    )


def product_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue and its arrivals as one full snapshot, with numeric-ordered keys."""
    existing = samples.raw_products(spark, folder).select("ProductID", "ProductName")
    start = change_batches.next_key(existing, "ProductID")
    arriving = existing.filter(F.col("ProductID").cast("bigint") % 4 == 0).withColumn(
        "ProductID", (F.col("ProductID").cast("bigint") + start).cast("string")
    )
    return change_batches.full_snapshot(existing, arriving)


def key_pool(spark: SparkSession, folder: str) -> DataFrame:
    lines = samples.table(spark, folder, "lineitem").select(F.col("l_partkey").cast("string").alias("ProductID"))
    return change_batches.key_pool(lines, "ProductID")


# --- all layers --------------------------------------------------------------


def _run_layers(spark: SparkSession, folder: str) -> TableStore:
    """Land, refine and publish raw files in two runs: seed, then customers who moved."""
    store = TableStore(spark, new_work_folder(spark, "layers"))

    def land(rows: DataFrame, dataset: str, name: str) -> None:
        write_csv(rows, f"{store.path(RAW, dataset)}/{name}")

    land(samples.raw_products(spark, folder), "products", "seed")
    land(samples.raw_customers(spark, folder, 1), "customers", "seed")
    land(samples.raw_orders(spark, folder), "orders", "seed")
    documents = change_batches.rate_documents(samples.exchange_rates(spark, folder))
    write_json_documents(documents, f"{store.path(RAW, 'exchange_rates')}/seed", F.col("document"), "RateDate")
    land_all(store, "run-1")
    refine_all(store, "run-1")
    land(samples.raw_customers(spark, folder, 2), "customers", "moved")
    land_all(store, "run-2")
    refine_all(store, "run-2")
    build_star(store, "run-2")
    return store


def layers_city_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales by the city where the customer lived on the day of the order."""
    store = _run_layers(spark, folder)
    fact = store.read(GOLD, "fact_sales")
    cities = store.read(GOLD, "dim_customer").select("CustomerSK", "City")
    return fact.join(cities, "CustomerSK", "left").groupBy("City", "LocalCurrency").agg(
        F.count("*").alias("TotalOrders"),
        F.sum("Quantity").alias("TotalQuantity"),
        exact_sum(F.col("LineTotalBaseCurrency")).alias("TotalRevenueUSD"),
    )


_PARTIES = {spec.name: spec for spec in (PRODUCTS, CUSTOMERS)}


def _run_parties(spark: SparkSession, folder: str) -> TableStore:
    """Products and customers through two runs; the second brings customers who moved."""
    store = TableStore(spark, new_work_folder(spark, "parties"))
    write_csv(samples.raw_products(spark, folder), f"{store.path(RAW, 'products')}/seed")
    for batch, name in ((1, "seed"), (2, "moved")):
        write_csv(samples.raw_customers(spark, folder, batch), f"{store.path(RAW, 'customers')}/{name}")
        land_all(store, f"run-{batch}", _PARTIES)
        refine_all(store, f"run-{batch}", _PARTIES)
    return store


def layer_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What both runs put aside; a full refresh rejects the same products again."""
    store = _run_parties(spark, folder)
    parts = [
        store.read(SILVER, f"{spec.name}{REJECTS_SUFFIX}").select(F.lit(spec.name).alias("dataset"), F.col(key).cast("long").alias("record_key"), RUN_ID)
        for spec, key in ((PRODUCTS, "ProductID"), (CUSTOMERS, "CustomerID"))
    ]
    return parts[0].unionByName(parts[1])


def layer_log(spark: SparkSession, folder: str) -> DataFrame:
    """The execution log of both runs without its times."""
    return _run_parties(spark, folder).read(AUDIT, EXECUTION_LOG).drop("event_timestamp", "error_message")


def layer_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the tables after both runs; one of them was never written."""
    store = _run_parties(spark, folder)
    tables = [(layer, name) for layer in (BRONZE, SILVER) for name in _PARTIES]
    tables += [(SILVER, f"{name}{REJECTS_SUFFIX}") for name in _PARTIES]
    return audit.table_profile(store, [*tables, (AUDIT, EXECUTION_LOG), (AUDIT, WATERMARKS), (SILVER, "orders")])


def layer_increment(spark: SparkSession, folder: str) -> DataFrame:
    """Versions by the run that opened them, and whether the mark stands at the last landing."""
    store = _run_parties(spark, folder)
    last = store.read(BRONZE, "customers").agg(F.unix_micros(F.max(INGESTED_AT))).first()[0]
    stands = audit.get_mark(store, "customers") == last
    return store.read(SILVER, "customers").select("CustomerID", "City", RUN_ID, IS_CURRENT, F.lit(stands).alias("mark_stands"))


def failed_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """One dataset breaks with a very long message; the other is refined, and the log tells of both."""
    store = TableStore(spark, new_work_folder(spark, "failing"))
    columns = {"p_partkey": "int", "p_name": "string", "p_brand": "string"}
    breaks = "raise_error(repeat('x', 3000)) IS NULL"
    registry = {"broken": DatasetSpec("broken", columns, reject_when=(breaks,)), "sound": DatasetSpec("sound", columns)}
    for name in registry:
        write_csv(samples.table(spark, folder, "part").select(*columns), f"{store.path(RAW, name)}/seed")
    land_all(store, "run-1", registry)
    try:
        refine_all(store, "run-1", registry)
    except LayerFailed as failure:
        failed = str(failure).partition(":")[0]
    log = store.read(AUDIT, EXECUTION_LOG).filter(F.col("layer") == SILVER)
    return log.select("dataset", "status", "records_in", F.length("error_message").alias("error_chars"), F.lit(failed).alias("raised"))


def audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text with the columns of a landing, then without all but two of these, completed and stamped by cleaning."""
    landed = add_landing_audit(all_as_strings(samples.table(spark, folder, "orders")), "run-1")
    landed = landed.withColumns({SOURCE_FILE: F.lit("orders.csv"), "_Checked": F.lit(True)})
    plain = add_missing(drop_technical(landed), {"o_orderkey": "bigint", "o_discount": "decimal(10,2)"})
    done = add_processing_audit(plain, "run-2")
    stamped = F.col(INGESTED_AT).isNotNull() & (F.col(INGESTED_AT) <= F.col(PROCESSED_AT))
    return done.select("o_orderkey", "o_orderdate", "o_discount", SOURCE_FILE, RUN_ID, stamped.alias("stamped"), F.lit(len(done.columns)).alias("n_columns"))


def published_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Two Gold tables rebuilt alone, published to the catalog and read back from there."""
    store = _run_parties(spark, folder)
    names = ("dim_customer", "dim_product")
    build_star(store, "run-2", only=names)
    database = "gold_" + store.base.rsplit("-", 1)[-1][:12]
    save_all_to_catalog(store, "run-2", database, names, location=f"{store.base}/catalog")
    customers, products = (spark.table(f"{database}.{name}") for name in names)
    return customers.select(
        F.lit("customer").alias("kind"), F.col("CustomerSK").alias("sk"), F.col("CustomerID").alias("id"), F.col("City").alias("name"),
        F.col(VALID_FROM).cast(_AS_NTZ).alias("since"),
    ).unionByName(products.select(
        F.lit("product").alias("kind"), F.col("ProductSK").alias("sk"), F.col("ProductID").alias("id"), F.col("ProductName").alias("name"),
        F.lit(None).cast(_AS_NTZ).alias("since"),
    ))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        dedupe_orders,
        distinct_rows,
        clean_products,
        rejects_products,
        clean_customers,
        clean_orders,
        ref_integrity_orders,
        phone_scrub,
        null_flags,
        record_hashes,
        record_hashes_exact,
        flatten_events,
        payload_keys,
        flatten_lines,
        unpivot_rates,
        scd2_first_load,
        scd2_users,
        scd2_table,
        scd2_many_batches,
        late_closures,
        pit_customer,
        pit_periods,
        pit_overlaps,
        current_customer,
        asof_fx,
        asof_fx_periods,
        dim_customer,
        dim_product,
        dim_date,
        fact_sales,
        agg_daily_store,
        agg_category,
        revenue_total,
        landed_csv,
        csv_folder,
        unregistered_files,
        mixed_headers,
        latest_file,
        rate_documents,
        upsert_watermark,
        schema_evolve,
        partitioned_table,
        month_replaced,
        evolve_overwrite,
        incremental_scan,
        catalog_preview,
        stream_landing,
        stream_history,
        stream_history_changes,
        run_summary,
        latest_rejects,
        reject_profile,
        dirty_products,
        dirt_share,
        repeated_orders,
        customer_changes,
        product_snapshot,
        key_pool,
        layers_city_sales,
        layer_rejects,
        layer_log,
        layer_profile,
        layer_increment,
        failed_dataset,
        audit_columns,
        published_gold,
    )
}
