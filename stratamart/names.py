"""Technical column names and fixed values shared by every layer."""

# Audit and history column names carried by stored tables.
SOURCE_FILE = "_SourceFile"
RUN_ID = "_AdfPipelineRunId"
INGESTED_AT = "_IngestionTimestamp"
PROCESSED_AT = "_ProcessedTimestamp"
REJECTED = "_IsRejected"
RECORD_HASH = "_SCD_RecordHash"
VALID_FROM = "_SCD_EffectiveStartDate"
VALID_TO = "_SCD_EffectiveEndDate"
IS_CURRENT = "_SCD_IsCurrent"

# Partition columns: of Bronze tables, prunes the incremental scan; of facts, the year and month of the order.
INGEST_DATE = "_IngestionDate"
SALES_MONTH = "_SalesMonth"

# Layer names and audit table names.
RAW, BRONZE, SILVER, GOLD, AUDIT = "raw", "bronze", "silver", "gold", "audit"
EXECUTION_LOG = "pipeline_execution_log"
FILE_REGISTRY = "bronze_file_registry"
WATERMARKS = "silver_watermark"
REJECTS_SUFFIX = "_rejected_records"

# Default currency and the currency of each store.
BASE_CURRENCY = "USD"
STORE_CURRENCY = {
    "ST001": "USD",
    "ST002": "USD",
    "ST003": "EUR",
    "ST004": "GBP",
    "ST005": "INR",
    "ST006": "INR",
    "ST007": "JPY",
    "ST008": "CAD",
    "ST009": "AUD",
    "ST010": "CNY",
}

# Gold tables, in publishing order.
GOLD_TABLES = (
    "dim_customer",
    "dim_product",
    "dim_date",
    "fact_sales",
    "agg_daily_sales_by_store",
    "agg_sales_by_category",
)
