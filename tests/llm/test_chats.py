from stratamart.llm.chats import BEGIN, END, collapse, format_chats


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, rendered string")


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "bot", "yes"),
    (2, 0, "user", "hi"), (2, 1, "bot", "yes"), (2, 2, "user", "more"),
    (3, 0, "user", "hi"), (3, 1, "bot", "no"),
    (4, 5, "user", "hi"), (4, 7, "bot", "no"),
    (5, 0, "user", None), (6, 0, "user", ""), (7, 0, None, "hi"),
    (8, None, "user", "first"), (8, 1, "user", "b"), (8, 1, "user", "a"), (8, 1, "user", "a"),
    (None, 0, "user", "alone"),
]


def test_snapshots_collapse(spark):
    got = {r["conv_id"]: (r["n_turns"], r["n_equal"]) for r in collapse(turns(spark, ROWS)).collect()}
    # 1 begins 2; 4 equals 3 whatever its turn numbers; null, empty and role differ.
    assert got == {2: (3, 1), 3: (2, 2), 5: (1, 1), 6: (1, 1), 7: (1, 1), 8: (3, 1), None: (1, 1)}


def test_rendering(spark):
    got = {r["conv_id"]: r["rendered"] for r in format_chats(turns(spark, ROWS)).collect()}
    assert got[3] == f"{BEGIN}user\nhi{END}\n{BEGIN}bot\nno{END}\n"
    assert got[8] == "".join(f"{BEGIN}user\n{t}{END}\n" for t in ("first", "a", "b"))
    assert got[5] == got[6] and got[None] == f"{BEGIN}user\nalone{END}\n"


def test_empty_and_native(spark):
    assert format_chats(turns(spark, ROWS).limit(0)).count() == 0
    plan = format_chats(turns(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
