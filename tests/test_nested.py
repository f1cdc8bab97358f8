from stratamart.operators.nested import flatten, parse_payload, wide_to_long
from stratamart.spec import WideToLong


def test_struct_becomes_columns(spark):
    df = spark.createDataFrame([((1, "John"),)], "customer struct<id:int,name:string>")
    out = flatten(df)
    assert out.columns == ["customer_id", "customer_name"]
    assert tuple(out.first()) == (1, "John")


def test_array_of_structs_becomes_rows(spark, rows):
    df = spark.createDataFrame([([(100,), (200,)],)], "orders array<struct<amount:int>>")
    out = flatten(df)
    assert out.columns == ["orders_amount"]
    assert rows(out) == [(100,), (200,)]


def test_deep_and_empty(spark, rows):
    df = spark.createDataFrame(
        [(1, ("x", [[1, 2], [3]])), (2, ("y", []))], "id int, a struct<b:string,c:array<array<int>>>"
    )
    assert rows(flatten(df)) == [(1, "x", 1), (1, "x", 2), (1, "x", 3), (2, "y", None)]


def test_sibling_arrays_multiply(spark):
    df = spark.createDataFrame([([1, 2], [3, 4, 5])], "a array<int>, b array<int>")
    assert flatten(df).count() == 6


def test_flat_frames_and_maps_are_untouched(spark):
    df = spark.createDataFrame([(1, {"k": 2})], "id int, m map<string,int>")
    assert flatten(df).schema == df.schema


def test_payload(spark, rows):
    df = spark.createDataFrame(
        [('{"base":"USD","rates":{"EUR":0.92,"GBP":0.79}}',), (None,), ('{"base":"USD","rates":{"EUR":0.91,"GBP":0.78}}',)],
        "raw_payload string",
    )
    out = parse_payload(df, {"base": "BaseCurrency", "absent": "x"})
    assert set(out.columns) == {"BaseCurrency", "rates_EUR", "rates_GBP"}
    assert sorted(r.rates_EUR for r in out.collect() if r.rates_EUR) == [0.91, 0.92]


def test_payload_with_schema_keeps_keys_the_sample_lacks(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":2,"b":3}',)], "raw_payload string")
    assert "b" in parse_payload(df, schema="a int, b int").columns


def test_no_payload_is_none(spark):
    assert parse_payload(spark.createDataFrame([(None,)], "raw_payload string")) is None


def test_unpivot_keeps_nulls(spark, rows):
    df = spark.createDataFrame([("2024-01-01", "USD", 0.9, None, 5)], "date string, base string, rates_EUR double, rates_JPY int, amount int")
    shape = WideToLong("rates_", "TargetCurrency", "ExchangeRate", {"date": "RateDate", "base": "BaseCurrency"})
    out = wide_to_long(df, shape)
    assert out.columns == ["RateDate", "BaseCurrency", "TargetCurrency", "ExchangeRate"]
    assert rows(out) == [("2024-01-01", "USD", "EUR", 0.9), ("2024-01-01", "USD", "JPY", None)]


def test_payloads_that_differ_keep_all_keys_and_values(spark, rows):
    texts = ['{"a":1}', '{"a":2,"b":3,"x y":"t"}', '{"a":2.5}', "no json", '{"c":1}', '{"c":"one"}', "[1]", None]
    out = parse_payload(spark.createDataFrame([(t,) for t in texts], "raw_payload string"))
    got = rows(out, "a", "b", "c", "x y")
    assert sorted((r for r in got if any(v is not None for v in r)), key=repr) == sorted(
        [(1.0, None, None, None), (2.0, 3, None, "t"), (2.5, None, None, None), (None, None, "1", None), (None, None, "one", None)], key=repr
    )


def test_taken_names_get_a_number(spark):
    df = spark.createDataFrame([((1, 2), 3, 4)], "a struct<b: int, B_2: int>, A_b int, a_b_2 int")
    out = flatten(df)
    assert out.columns == ["A_b", "a_b_2", "a_b_3", "a_B_2_2"] and tuple(out.first()) == (3, 4, 1, 2)
