"""Declarative dataset specs: what a dataset looks like and which rules it obeys.

A spec is data only. Landing, cleaning and history code read it; nothing about a
dataset is hard-coded elsewhere.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from stratamart.names import SILVER


@dataclass(frozen=True)
class RefCheck:
    """Rows whose ``column`` has no partner in ``layer.table.ref_column`` are rejected."""

    column: str
    table: str
    ref_column: str
    layer: str = SILVER


@dataclass(frozen=True)
class History:
    """Slowly changing dimension (type 2) settings."""

    key: str
    tracked: tuple[str, ...]
    effective: str


@dataclass(frozen=True)
class WideToLong:
    """Columns starting with ``prefix`` become (name, value) rows; ``keep`` maps old to new names."""

    prefix: str
    name_column: str
    value_column: str
    keep: Mapping[str, str]


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: Mapping[str, str]
    raw_format: str = "csv"
    load: str = "append"
    dedupe_keys: tuple[str, ...] = ()
    date_formats: Mapping[str, str] = field(default_factory=dict)
    upper_case: tuple[str, ...] = ()
    title_case: tuple[str, ...] = ()
    phones: tuple[str, ...] = ()
    reject_when: tuple[str, ...] = ()
    references: tuple[RefCheck, ...] = ()
    required: tuple[str, ...] | None = None
    history: History | None = None
    wide_to_long: WideToLong | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    raw_schema: str | None = None

    @property
    def required_columns(self) -> tuple[str, ...]:
        """Columns that must not be NULL; every declared column unless narrowed."""
        return tuple(self.columns) if self.required is None else self.required

    @property
    def full_refresh(self) -> bool:
        return self.load == "overwrite_latest"


# Column names, types, keys and reject rules of the four retail datasets.
PRODUCTS = DatasetSpec(
    name="products",
    columns={
        "ProductID": "int",
        "ProductName": "string",
        "Category": "string",
        "SubCategory": "string",
        "Brand": "string",
        "CostPrice": "decimal(10,2)",
    },
    load="overwrite_latest",
    dedupe_keys=("ProductID",),
    title_case=("Category",),
    reject_when=("CostPrice IS NOT NULL AND CostPrice <= 0",),
)

CUSTOMERS = DatasetSpec(
    name="customers",
    columns={
        "CustomerID": "int",
        "FirstName": "string",
        "LastName": "string",
        "Email": "string",
        "Phone": "string",
        "City": "string",
        "State": "string",
        "LastUpdated": "timestamp",
    },
    dedupe_keys=("CustomerID", "LastUpdated"),
    upper_case=("State",),
    phones=("Phone",),
    history=History(
        key="CustomerID",
        tracked=("FirstName", "LastName", "Email", "Phone", "City", "State"),
        effective="LastUpdated",
    ),
)

EXCHANGE_RATES = DatasetSpec(
    name="exchange_rates",
    columns={
        "BaseCurrency": "string",
        "TargetCurrency": "string",
        "ExchangeRate": "decimal(12,6)",
        "RateDate": "date",
    },
    raw_format="json",
    dedupe_keys=("BaseCurrency", "TargetCurrency", "RateDate"),
    date_formats={"RateDate": "yyyy-MM-dd"},
    reject_when=("ExchangeRate IS NOT NULL AND ExchangeRate <= 0",),
    wide_to_long=WideToLong(
        prefix="rates_",
        name_column="TargetCurrency",
        value_column="ExchangeRate",
        keep={"date": "RateDate", "base": "BaseCurrency"},
    ),
)

ORDERS = DatasetSpec(
    name="orders",
    columns={
        "OrderID": "bigint",
        "CustomerID": "int",
        "ProductID": "int",
        "OrderDate": "date",
        "Quantity": "int",
        "UnitPrice": "decimal(10,2)",
        "StoreCode": "string",
    },
    dedupe_keys=("OrderID",),
    date_formats={"OrderDate": "yyyy-MM-dd"},
    reject_when=("Quantity IS NOT NULL AND Quantity <= 0", "UnitPrice IS NOT NULL AND UnitPrice <= 0"),
    references=(
        RefCheck("CustomerID", "customers", "CustomerID"),
        RefCheck("ProductID", "products", "ProductID"),
    ),
)

# Order matters: tables that others refer to are loaded before them.
REGISTRY: dict[str, DatasetSpec] = {
    spec.name: spec for spec in (PRODUCTS, CUSTOMERS, EXCHANGE_RATES, ORDERS)
}
