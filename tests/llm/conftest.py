import random

import pytest


@pytest.fixture
def documents(spark):
    """A frame of documents with columns that clash with names of results, from (doc_id, text, lang, source) rows."""

    def build(rows):
        rows = [(*r, *(None,) * (4 - len(r))) for r in rows]
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return frame.selectExpr("*", "'x' as score", "1 as labels", "2 as spans", "3 as size", "'k' as key", "4 as n", "'t' as target", "char_length(text) as n_chars")

    return build


def words(n, seed, among=400):
    pick = random.Random(seed)
    return [f"w{pick.randrange(among)}" for _ in range(n)]


#: Null and repeated ids, null, empty and blank texts, repeated rows and a very long text.
EDGES = [
    (None, "one two three four five six"), (1, None), (2, ""), (3, " \t\n"), (4, "same text again for ever"), (4, "same text again for ever"),
    (5, "same text again for ever"), (None, None), (6, " ".join(words(30_000, 1, 5000))),
]
