import random
from datetime import datetime, timedelta
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from stratamart.names import IS_CURRENT, SILVER, VALID_FROM, VALID_TO
from stratamart.operators.scd2 import fold_batch
from stratamart.plans.audit import closed_before_start
from stratamart.sources import tables
from stratamart.sources.tables import TableStore
from stratamart.spec import History

CITY = History(key="CustomerID", tracked=("City",), effective="LastUpdated")
BATCH = "CustomerID int, City string, LastUpdated timestamp"
SHOWN = ("CustomerID", "City", VALID_FROM, VALID_TO, IS_CURRENT)
JAN, JUN, SEP = datetime(2024, 1, 1), datetime(2024, 6, 1), datetime(2024, 9, 1)


def fold_by_hand(state, batch):
    """Plain-Python history: list of [key, city, start, end, current]."""
    latest = {}
    for key, city, at in sorted(batch, key=lambda r: (r[2], [-ord(c) for c in r[1]])):
        latest[key] = (city, at)
    for key, (city, at) in latest.items():
        current = [v for v in state if v[0] == key and v[4]]
        if current and current[0][1] == city:
            continue
        for version in current:
            version[3], version[4] = at, False
        state.append([key, city, at, None, True])
    return state


def test_first_load_is_all_current(spark, rows):
    out = fold_batch(None, spark.createDataFrame([(1, "Chennai", JAN), (2, "Mumbai", JAN)], BATCH), CITY)
    assert rows(out, *SHOWN) == [(1, "Chennai", JAN, None, True), (2, "Mumbai", JAN, None, True)]


def test_change_closes_and_opens(spark, rows):
    first = fold_batch(None, spark.createDataFrame([(1, "Chennai", JAN), (2, "Mumbai", JAN)], BATCH), CITY)
    out = fold_batch(first, spark.createDataFrame([(1, "Bangalore", JUN), (2, "Mumbai", JUN), (3, "Pune", JUN)], BATCH), CITY)
    assert rows(out, *SHOWN) == sorted(
        [
            (1, "Chennai", JAN, JUN, False),
            (1, "Bangalore", JUN, None, True),
            (2, "Mumbai", JAN, None, True),
            (3, "Pune", JUN, None, True),
        ],
        key=repr,
    )


def test_only_the_latest_row_of_a_batch_counts(spark, rows):
    out = fold_batch(None, spark.createDataFrame([(1, "A", JAN), (1, "B", JUN)], BATCH), CITY)
    assert rows(out, *SHOWN) == [(1, "B", JUN, None, True)]


def test_null_equals_empty_in_the_hash(spark):
    out = fold_batch(None, spark.createDataFrame([(1, None, JAN)], BATCH), CITY)
    assert out.first()["_SCD_RecordHash"] == sha256(b"").hexdigest()
    assert fold_batch(out, spark.createDataFrame([(1, "", JUN)], BATCH), CITY).count() == 1


def test_late_change_still_closes(spark, rows):
    first = fold_batch(None, spark.createDataFrame([(1, "A", JUN)], BATCH), CITY)
    late = fold_batch(first, spark.createDataFrame([(1, "B", JAN)], BATCH), CITY)
    assert rows(late, *SHOWN) == sorted([(1, "A", JUN, JAN, False), (1, "B", JAN, None, True)], key=repr)
    assert closed_before_start(late, VALID_FROM, VALID_TO).first()[0] == 1


@pytest.mark.parametrize("bound", [1000, 0])
def test_random_batches_agree_with_plain_python(spark, rows, bound):
    draw = random.Random(11)
    state, df = [], None
    for batch_no in range(3):
        batch = [
            (draw.choice([1, 1, 1, draw.randrange(12)]), draw.choice("ABC"), JAN + timedelta(days=30 * batch_no, hours=n))
            for n in range(30)
        ]
        state = fold_by_hand(state, batch)
        df = fold_batch(df, spark.createDataFrame(batch, BATCH), CITY, bound)
    assert rows(df, *SHOWN) == sorted((tuple(v) for v in state), key=repr)
    assert df.filter(IS_CURRENT).count() == df.select("CustomerID").distinct().count()


def test_table_history(spark, store, rows):
    def batch(*data, schema=BATCH):
        return spark.createDataFrame(list(data), schema)

    assert store.upsert_history(batch((1, "Chennai", JAN), (2, "Mumbai", JAN)), SILVER, "c", CITY, "r1") == (2, 0)
    second = batch((1, "Bangalore", JUN, "560"), (2, "Mumbai", JUN, "400"), schema=BATCH + ", Zip string")
    assert store.upsert_history(second, SILVER, "c", CITY, "r2") == (1, 1)
    before = rows(store.read(SILVER, "c"), *SHOWN)
    assert store.upsert_history(second, SILVER, "c", CITY, "again") == (0, 2)
    assert rows(store.read(SILVER, "c"), *SHOWN) == before
    assert store.upsert_history(batch((1, "Delhi", SEP)), SILVER, "c", CITY, "r3") == (1, 0)
    assert rows(store.read(SILVER, "c"), *SHOWN, "Zip", "_AdfPipelineRunId") == sorted(
        [
            (1, "Chennai", JAN, JUN, False, None, "r1"),
            (1, "Bangalore", JUN, SEP, False, "560", "r2"),
            (1, "Delhi", SEP, None, True, None, "r3"),
            (2, "Mumbai", JAN, None, True, None, "r1"),
        ],
        key=repr,
    )


def test_reading_current_versions_prunes_closed_ones(spark, store):
    for at, city in ((JAN, "A"), (JUN, "B")):
        store.upsert_history(spark.createDataFrame([(1, city, at)], BATCH), SILVER, "c", CITY, "r")
    current = store.read(SILVER, "c").filter(IS_CURRENT)
    assert len(current.inputFiles()) > 0
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_snapshot" in plan
    assert current.count() == 1


def current_files(store, name):
    return {r[0] for r in store.read(SILVER, name).filter(IS_CURRENT).select(F.input_file_name()).collect()}


def test_only_buckets_with_changes_are_rewritten(spark, store, rows):
    people = [(k, "A", JAN) for k in range(200)] + [(None, "A", JAN)]
    store.upsert_history(spark.createDataFrame(people, BATCH), SILVER, "c", CITY, "r1", buckets=16)
    before = current_files(store, "c")
    assert len(before) == 16
    batch = [(5, "B", JUN), (900, "N", JUN), (6, "A", JUN)]
    assert store.upsert_history(spark.createDataFrame(batch, BATCH), SILVER, "c", CITY, "r2") == (2, 1)
    touched = {f.split("_bucket=")[1].split("/")[0] for f in before - current_files(store, "c")}
    assert 1 <= len(touched) <= 2 and len(before & current_files(store, "c")) >= 14
    expected = fold_by_hand(fold_by_hand([], [p for p in people if p[0] is not None]), batch) + [[None, "A", JAN, None, True]]
    assert rows(store.read(SILVER, "c"), *SHOWN) == sorted((tuple(v) for v in expected), key=repr)


def test_random_batches_in_buckets_agree_with_plain_python(spark, store, rows):
    draw, state = random.Random(4), []
    for number in range(4):
        batch = [(draw.randrange(40), draw.choice("AB"), JAN + timedelta(days=draw.randrange(200), hours=n)) for n in range(12)]
        state = fold_by_hand(state, batch)
        store.upsert_history(spark.createDataFrame(batch, BATCH), SILVER, "c", CITY, f"r{number}", buckets=5)
    assert rows(store.read(SILVER, "c"), *SHOWN) == sorted((tuple(v) for v in state), key=repr)


def test_a_null_key_is_a_key(spark, store, rows):
    for at, city, changes in ((JAN, "A", 1), (JUN, "A", 0), (SEP, "B", 1)):
        assert store.upsert_history(spark.createDataFrame([(None, city, at)], BATCH), SILVER, "c", CITY, "r")[0] == changes
    assert rows(store.read(SILVER, "c"), *SHOWN) == [(None, "A", JAN, SEP, False), (None, "B", SEP, None, True)]


def test_buckets_follow_the_keys_when_all_are_rewritten(spark, store, rows, monkeypatch):
    monkeypatch.setattr(tables, "KEYS_PER_BUCKET", 10)

    def load(keys, city, at):
        store.upsert_history(spark.createDataFrame([(k, city, at) for k in keys], BATCH), SILVER, "c", CITY, "r")
        return len(current_files(store, "c"))

    assert load(range(10), "A", JAN) == 1
    assert load(range(60), "B", JUN) == 6
    assert load([3], "C", SEP) == 6
    assert store.read(SILVER, "c").count() == 10 + 60 + 1 and store.read(SILVER, "c").filter(IS_CURRENT).count() == 60


def test_late_changes_leave_a_mark(spark, store):
    for city, at, late in (("A", JAN, False), ("B", SEP, False), ("C", JUN, True), ("D", SEP, True)):
        store.upsert_history(spark.createDataFrame([(1, city, at)], BATCH), SILVER, "c", CITY, "r")
        assert store.may_overlap(SILVER, "c") is late


def test_a_batch_number_counts_once(spark, store, rows):
    """An older batch that comes again after a newer one changes nothing; another stream has its own numbers."""
    first, second = (spark.createDataFrame([(1, city, at)], BATCH) for city, at in (("A", JAN), ("B", JUN)))
    for batch, number, changed in ((first, 0, 1), (second, 1, 1), (first, 0, 0), (second, 1, 0), (second, 2, 0)):
        assert store.upsert_history(batch, SILVER, "c", CITY, "r", batch_number=("s", number))[0] == changed
    assert rows(store.read(SILVER, "c"), *SHOWN) == sorted([(1, "A", JAN, JUN, False), (1, "B", JUN, None, True)], key=repr)
    assert store.upsert_history(first, SILVER, "c", CITY, "r", batch_number=("t", 0))[0] == 1


def test_a_failed_write_leaves_the_table(spark, store, rows, monkeypatch):
    store.upsert_history(spark.createDataFrame([(1, "A", JAN), (2, "A", JAN)], BATCH), SILVER, "c", CITY, "r", buckets=2)
    before = rows(store.read(SILVER, "c"))
    second = spark.createDataFrame([(1, "B", JUN)], BATCH)
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_switch", lambda *_: 1 / 0)  # rows are written, the switch fails
        with pytest.raises(ZeroDivisionError):
            store.upsert_history(second, SILVER, "c", CITY, "r")
    assert rows(store.read(SILVER, "c")) == before
    assert store.upsert_history(second, SILVER, "c", CITY, "r") == (1, 0)
    assert store.read(SILVER, "c").count() == 3


def test_history_tables_refuse_plain_appends(spark, store):
    rows = spark.createDataFrame([(1, "A", JAN)], BATCH)
    store.upsert_history(rows, SILVER, "c", CITY, "r")
    with pytest.raises(ValueError, match="history"):
        store.write(rows, SILVER, "c")
