import random

from pyspark.sql import functions as F

from stratamart.operators.dedupe import drop_repeats, first_per_key, settle_repeats
from stratamart.operators.projection import (
    add_landing_audit,
    add_missing,
    add_processing_audit,
    all_as_strings,
    drop_technical,
    rename_present,
)
from stratamart.operators.quality import accepted, clean_and_flag, flag_nulls, flag_orphans, rejected
from stratamart.spec import ORDERS, PRODUCTS, DatasetSpec


def test_projections(spark):
    df = spark.createDataFrame([(1, "Alice", "x")], "CustomerID int, Name string, _SourceFile string")
    landed = add_landing_audit(df, "test-run-abc-123")
    assert landed.columns == [*df.columns, "_AdfPipelineRunId", "_IngestionTimestamp"]
    assert landed.first()["_AdfPipelineRunId"] == "test-run-abc-123"
    assert add_processing_audit(df, "r").columns[-1] == "_ProcessedTimestamp"
    assert set(drop_technical(landed).columns) == {"CustomerID", "Name", "_SourceFile", "_IngestionTimestamp"}
    assert {t for _, t in all_as_strings(df).dtypes} == {"string"}
    assert rename_present(df, {"Name": "N", "none": "z"}).columns == ["CustomerID", "N", "_SourceFile"]
    assert dict(add_missing(df, {"Name": "string", "Zip": "int"}).dtypes)["Zip"] == "int"


def test_last_landed_row_wins(spark, rows):
    df = spark.createDataFrame(
        [("1", "old", "2024-01-01", "a"), ("1", "new", "2024-01-02", "a"), ("1", "file", "2024-01-02", "b"), ("2", "only", "2024-01-01", "a"), (None, "n1", "2024-01-01", "a"), (None, "n2", "2024-01-01", "a")],
        "id string, v string, _IngestionTimestamp string, _SourceFile string",
    )
    assert rows(drop_repeats(df, ["id"]), "id", "v") == [("1", "file"), ("2", "only"), (None, "n1")]


def test_text_keys_differ_before_cleaning(spark):
    df = spark.createDataFrame([("1",), (" 1",), ("1",)], "id string")
    assert drop_repeats(df, ["id"]).count() == 2
    assert drop_repeats(df).count() == 2


def test_settled_repeats_equal_dropped_repeats(spark, rows):
    draw = random.Random(5)
    data = [(n if n % 3 else 7, draw.choice([None, "a", "b"]), draw.randrange(4)) for n in range(200)] + [(None, "a", 1), (None, "b", 1)]
    df = spark.createDataFrame(data, "id int, k string, v int")
    for keys in (["id"], ["id", "k"]):
        expected = rows(drop_repeats(df, keys))
        for bound in (1000, 0):
            assert rows(settle_repeats(df, keys, bound)) == expected
    unique = spark.range(10)
    assert settle_repeats(unique, ["id"]) is unique


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_null_flags(spark, rows):
    df = spark.createDataFrame([(1001, 1, 2), (1002, None, 1), (1004, 3, 1)], "OrderID bigint, ProductID int, Quantity int")
    assert rows(flag_nulls(df, ["OrderID", "ProductID", "absent"]), "OrderID", "_IsRejected") == [(1001, False), (1002, True), (1004, False)]
    assert flag_nulls(df, []).filter("_IsRejected").count() == 0


def test_products_are_cleaned_and_quarantined(spark, rows):
    raw = spark.createDataFrame(
        [
            ("101", "Lamp", "home", "Light", "Acme", "$12.50"),
            ("102", "Rug", "HOME", "N/A", "Acme", "30.00"),
            ("103", "Sofa", "Home", "Seat", "Acme", "0"),
            ("104", "Bed", "Home", "Sleep", "Acme", "1-2"),
            ("101", "Lamp", "home", "Light", "Acme", "$12.50"),
        ],
        "ProductID string, ProductName string, Category string, SubCategory string, Brand string, CostPrice string",
    )
    flagged = clean_and_flag(raw, PRODUCTS)
    assert flagged.count() == accepted(flagged).count() + rejected(flagged).count() == 4
    assert rows(accepted(flagged), "ProductID", "Category") == [(101, "Home")]
    assert rows(rejected(flagged), "ProductID") == [(102,), (103,), (104,)]


def test_unknown_rules_reject_and_required_can_be_narrowed(spark, rows):
    spec = DatasetSpec("t", {"a": "int"}, reject_when=("b > 5",), required=())
    df = spark.createDataFrame([("1", 9), ("2", 1), ("3", None), ("x", 1)], "a string, b int")
    out = clean_and_flag(df, spec)
    assert rows(out, "b", "_IsRejected") == [(1, False), (1, False), (9, True), (None, True)]


def test_missing_declared_column_rejects_every_row(spark):
    df = spark.createDataFrame([("1",)], "a string")
    out = clean_and_flag(df, DatasetSpec("t", {"a": "int", "b": "date"}))
    assert out.filter("_IsRejected").count() == 1 and dict(out.dtypes)["b"] == "date"


def test_extra_columns_pass_through(spark):
    df = spark.createDataFrame([("1", " n/a ")], "a string, extra string")
    assert clean_and_flag(df, DatasetSpec("t", {"a": "int"})).first()["extra"] == " n/a "


def test_orphans_agree_with_sets_for_small_and_large_references(spark, rows):
    draw = random.Random(7)
    known = [(i % 40,) for i in range(100)]
    facts = [(n, draw.choice([None, 5, 5, 5, 77, 77, draw.randrange(60)])) for n in range(400)]
    df = spark.createDataFrame(facts, "n int, k int")
    reference = spark.createDataFrame(known, "id int")
    expected = sorted(((n, k is not None and k >= 40) for n, k in facts), key=repr)
    for bound in (1000, 10, 0):
        out = flag_orphans(df, "k", reference, "id", "orphan", max_broadcast_rows=bound)
        assert out.columns == ["n", "k", "orphan"]
        assert rows(out, "n", "orphan") == expected


def test_large_references_of_whole_numbers_need_no_second_run_of_the_rows(spark, rows):
    """More keys than the bound, but few words of 64 neighbours: ``keys_from`` is not asked."""

    def never():
        raise AssertionError("the rows were computed again")

    ends = [-(2**63), -(2**31), -129, -128, -65, -64, -63, -1, 0, 1, 63, 64, 127, 128, 2**31, 2**63 - 1]
    known = {*range(-70, 400, 2), *ends[::2]}
    facts = [(n, k) for n, k in enumerate([None, None, *ends, *range(-75, 410)])]
    df = spark.createDataFrame(facts, "n int, k bigint")
    reference = spark.createDataFrame([(k,) for k in [None, 0, *known]], "id bigint")
    out = flag_orphans(df, "k", reference, "id", "orphan", never, max_broadcast_rows=30)
    assert out.columns == ["n", "k", "orphan"]
    assert rows(out, "n", "orphan") == sorted(((n, k is not None and k not in known) for n, k in facts), key=repr)
    narrow = df.filter("k between -1000 and 1000").withColumn("k", F.col("k").cast("int"))
    out = flag_orphans(narrow, "k", reference, "id", "orphan", never, max_broadcast_rows=30)
    assert rows(out, "k", "orphan") == sorted(((k, k not in known) for _, k in facts if k is not None and -1000 <= k <= 1000), key=repr)


def test_orders_with_both_references(spark, rows):
    raw = spark.createDataFrame(
        [
            ("1", "1", "10", "2024-01-01", "2", "5.00", "ST001"),
            ("2", "9", "10", "2024-01-01", "2", "5.00", "ST001"),
            ("3", "1", "99", "2024-01-01", "2", "5.00", "ST001"),
            ("4", "1", "10", "2024-13-01", "2", "5.00", "ST001"),
            ("5", "1", "10", "2024-01-01", "0", "5.00", "ST001"),
            ("6", "1", "10", "2024-01-01", "1", "", "ST001"),
            ("7", "1", "10", "2024-01-01", "1", "5.00", "unknown"),
        ],
        "OrderID string, CustomerID string, ProductID string, OrderDate string, Quantity string, UnitPrice string, StoreCode string",
    )
    tables = {
        "customers": spark.createDataFrame([(1,), (1,)], "CustomerID int"),
        "products": spark.createDataFrame([(10,)], "ProductID int"),
    }
    for bound in (1000, 0):
        flagged = clean_and_flag(raw, ORDERS, lambda check: tables[check.table], bound)
        assert rows(accepted(flagged), "OrderID") == [(1,)]
        assert flagged.count() == 7
    skipped = clean_and_flag(raw, ORDERS, lambda check: None)
    assert rows(accepted(skipped), "OrderID") == [(1,), (2,), (3,)]
