import os

import pytest
from pyspark.sql import functions as F

from stratamart.names import AUDIT
from stratamart.sources.exports import (
    JdbcTarget,
    preview,
    save_to_catalog,
    write_csv,
    write_json_documents,
)
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
from stratamart.streaming.files import land_stream, refine_history_stream
from stratamart.spec import History


def put(folder, name, text, at=None):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text)
    if at:
        os.utime(path, (at, at))
    return str(path)


def test_listing_hides_marked_names_and_missing_folders(spark, tmp_path, rows):
    put(tmp_path / "raw" / "a", "one.csv", "x\n1\n")
    put(tmp_path / "raw" / "b", "two.csv", "x\n1\n2\n")
    put(tmp_path / "raw", "_SUCCESS", "")
    assert rows(list_files(spark, str(tmp_path / "raw")), "name", "size") == [("one.csv", 4), ("two.csv", 6)]
    assert list_files(spark, str(tmp_path / "none")).count() == 0


def test_registered_files_are_passed_over_per_dataset(spark, store, tmp_path, rows):
    raw = tmp_path / "raw"
    put(raw, "a.csv", "x\n1\n")
    assert rows(new_files(store, "orders", str(raw)), "name") == [("a.csv",)]
    register_files(store, "orders", new_files(store, "orders", str(raw)), "r1")
    put(raw, "b.csv", "x\n1\n")
    assert rows(new_files(store, "orders", str(raw)), "name") == [("b.csv",)]
    assert new_files(store, "customers", str(raw)).count() == 2
    registered = store.read(AUDIT, "bronze_file_registry").first()
    assert (registered.file_name, registered.file_size, registered.pipeline_run_id) == ("a.csv", 4, "r1")


def test_newest_file(spark, tmp_path, rows):
    put(tmp_path, "old.csv", "x", 1_000_000)
    put(tmp_path, "late.csv", "x", 2_000_000)
    assert rows(newest(list_files(spark, str(tmp_path))), "name") == [("late.csv",)]
    assert newest(list_files(spark, str(tmp_path / "none"))).count() == 0


def test_csv_is_text_with_its_source(spark, tmp_path):
    path = put(tmp_path, "c.csv", "CustomerID,FirstName,LastUpdated\n1,Alice,2024-01-01 10:00:00\n")
    df = read_csv(spark, [path])
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.first()["_SourceFile"].endswith("/c.csv")


def test_other_headers_are_refused_then_matched_by_name(spark, tmp_path, rows):
    for name, text in (("a.csv", "A,B\n1,2\n"), ("b.csv", 'B,"A"\n3,4\n5,\n'), ("c d.csv", "A,B,C\n5,6,7\n"), ("e.csv", "A,B\n")):
        put(tmp_path / "raw", name, text)
    raw = str(tmp_path / "raw")
    with pytest.raises(Exception):
        read_csv(spark, raw).collect()
    files = list_files(spark, raw)
    headers = csv_headers(spark, raw, files)
    assert rows(headers.select("header").distinct()) == [("A,B",), ("A,B,C",), ('B,"A"',)]
    expected = [("1", "2", None), ("4", "3", None), ("5", "6", "7"), (None, "5", None)]
    mixed = read_mixed_csv(spark, raw, files, headers)
    assert rows(mixed, "A", "B", "C") == sorted(expected, key=repr) and mixed.columns == ["A", "B", "C", "_SourceFile"]
    some = files.filter("name != 'c d.csv'")
    assert rows(read_mixed_csv(spark, raw, some, csv_headers(spark, raw, some)), "A", "B") == sorted((e[:2] for e in expected if not e[2]), key=repr)


def test_only_rows_of_new_files_are_read(spark, store, tmp_path, rows):
    """Registered files drop out, older ones already by their time; names with blanks match."""
    raw = tmp_path / "raw"
    for n, name in enumerate(("old.csv", "seen later.csv", "new one.csv", "new.csv")):
        put(raw, name, f"x\n{n}\n", 1_000_000 + 1000 * n)
    listing = list_files(spark, str(raw))
    register_files(store, "t", listing.filter("name like 'old%' or name like 'seen%'"), "r1")
    os.utime(raw / "seen later.csv", (2_000_000, 2_000_000))
    fresh = new_files(store, "t", str(raw))
    oldest = fresh.agg(F.unix_micros(F.min("modificationTime"))).first()[0]
    scan = read_csv(spark, str(raw), oldest=oldest)
    assert rows(scan, "x") == [("1",), ("2",), ("3",)]
    assert rows(rows_of(scan, fresh), "x") == [("2",), ("3",)]
    plan = rows_of(scan, fresh)._jdf.queryExecution().executedPlan().toString()
    assert "old.csv" not in "".join(scan.inputFiles()) and "LeftSemi" in plan


def test_csv_written_and_read_back(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, None, "x,y"), (2, 2.5, '"q"')], "a int, b double, c string")
    write_csv(df, str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    assert rows(read_csv_folder(spark, str(tmp_path / "out"))) == [("1", None, "x,y"), ("2", "2.5", '"q"')]


def test_json_documents(spark, tmp_path, rows):
    put(tmp_path / "raw", "d.json", '{\n "base": "USD",\n "rates": {"EUR": 0.92}\n}')
    df = read_json_documents(spark, str(tmp_path / "raw"))
    assert rows(df.select("base", "rates.EUR")) == [("USD", "0.92")]
    assert df.first()["_SourceFile"].endswith("d.json")
    write_json_documents(spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string"), str(tmp_path / "out"), one_file_per="a")
    assert rows(read_json_documents(spark, str(tmp_path / "out"), "a int, b string"), "a", "b") == [(1, "x"), (2, "y")]


def test_above_mark(spark):
    df = spark.range(5).withColumn("_IngestionTimestamp", F.timestamp_seconds("id"))
    assert above_mark(df, F.timestamp_seconds(F.lit(2))).count() == 2 and above_mark(df, None).count() == 5


def test_jdbc_options():
    target = JdbcTarget("jdbc:x://host/db", "me", "secret", extra={"tableLock": "true"})
    assert target.options("fact_sales") == {
        "url": "jdbc:x://host/db",
        "dbtable": "dbo.fact_sales",
        "user": "me",
        "password": "secret",
        "tableLock": "true",
    }
    assert JdbcTarget("u", schema=None).options("t") == {"url": "u", "dbtable": "t"}


def test_catalog(spark, tmp_path):
    for n in (60, 70):
        save_to_catalog(spark.range(n), "gold_check", "t", str(tmp_path / "db"))
    assert spark.table("gold_check.t").count() == 70
    assert preview(spark, "gold_check", "t").count() == 50


def test_stream_lands_each_file_once(spark, tmp_path):
    raw, bronze, progress = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "progress")
    counts = []
    for run, name in enumerate(["a.csv", None, "b.csv"]):
        if name:
            put(raw, name, "x\n1\n")
        source = spark.readStream.option("header", True).schema("x string").csv(str(raw))
        land_stream(source, bronze, progress, f"r{run}")
        counts.append(spark.read.parquet(bronze).count())
    assert counts == [1, 1, 2]


def test_stream_history_survives_a_repeated_batch(spark, store, tmp_path):
    raw = tmp_path / "raw"
    history = History("k", ("v",), "at")
    put(raw, "a.csv", "k,v,at\n1,x,2024-01-01\n")
    for progress in ("p1", "p1", "p2"):  # p2 starts over and sees the file again
        source = spark.readStream.option("header", True).schema("k int, v string, at timestamp").csv(str(raw))
        refine_history_stream(store, source, "t", history, "r", str(tmp_path / progress))
    assert store.read("silver", "t").count() == 1


def test_stream_history_over_several_batches_and_a_crash(spark, store, tmp_path, rows, monkeypatch):
    """A file a batch; the run breaks after the table has switched to the second batch, before the stream knows."""
    raw, progress, history = tmp_path / "raw", str(tmp_path / "p"), History("k", ("v",), "at")
    for n, text in enumerate(("1,x,2024-01-01\n2,x,2024-01-01", "1,y,2024-02-01", "1,x,2024-03-01\n3,z,2024-03-01")):
        put(raw, f"{n}.csv", f"k,v,at\n{text}\n", 1_000_000 + n)

    def run():
        source = spark.readStream.option("header", True).option("maxFilesPerTrigger", 1)
        refine_history_stream(store, source.schema("k int, v string, at timestamp").csv(str(raw)), "t", history, "r", progress)

    upsert, calls = store.upsert_history, []

    def breaking(*args, **how):
        calls.append(how["batch_number"][1])
        done = upsert(*args, **how)
        if calls == [0, 1]:
            raise RuntimeError("lost after the switch")
        return done

    monkeypatch.setattr(store, "upsert_history", breaking)
    with pytest.raises(Exception, match="lost after the switch"):
        run()
    run()
    run()
    assert calls == [0, 1, 1, 2]
    shown = [(r["k"], r["v"], r["_SCD_EffectiveStartDate"].month, r["_SCD_IsCurrent"]) for r in store.read("silver", "t").collect()]
    assert sorted(shown) == [(1, "x", 1, False), (1, "x", 3, True), (1, "y", 2, False), (2, "x", 1, True), (3, "z", 3, True)]
    assert upsert(store.read("silver", "t").limit(0).select("k", "v", "at"), "silver", "t", history, "r") == (0, 0)
