import random
import re
import time
from hashlib import sha256
from math import erfc, exp, log, sqrt

import pytest
from pyspark.sql import functions as F

from stratamart.llm.secret_scan import ALPHABETS, TOKEN, encoding_of, p_random, places, redacted, scan_secrets, with_spans

from .conftest import EDGES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)


def plain(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return [sum(k == i for _, k, _ in spans) for i in range(3)], sha256(joined.encode()).hexdigest()


def test_base_spans_equal_brute_force(spark, documents):
    pick = random.Random(8)
    parts = ["token", "secret=", " : ", "'", '"', "api_key", "apikey=", "PassWord", "abcdefgh", "AKIA", "ABCDEF0123456789", "é", "𝄞", "deadbeef" * 4, "=", " ", "zz.", "\n", "short"]
    rows = [(k, "".join(pick.choices(parts, k=30))) for k in range(300)]
    got = {r["doc_id"]: r for r in scan_secrets(documents(rows)).collect()}
    for doc_id, text in rows:
        r = got[doc_id]
        assert ([r["n_assign"], r["n_access"], r["n_hex"]], r["base_sha256"]) == plain(text), text


def test_battery_tells_random_tokens_from_patterned_ones(spark, documents):
    pick = random.Random(1)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    random_ones = ["x" + "".join(pick.choices(alphabet, k=38)) + "9aZ" for _ in range(60)]
    patterned = ["Ab1" * 14, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaB1a", "Version1Version1Version1Version1Version1aa"] * 5
    rows = [(k, f"see {t} here") for k, t in enumerate(random_ones + patterned)]
    got = {r["doc_id"]: r["n_random"] for r in scan_secrets(documents(rows)).collect()}
    assert sum(got[k] for k in range(60)) >= 54
    assert sum(got[k] for k in range(60, 75)) == 0
    assert scan_secrets(documents([(1, "an ordinary pneumonoultramicroscopicsilicovolcanoconiosis word")])).first()["spans"] == ""


def test_redaction_cuts_only_spans(spark, documents):
    rows = [(1, "a token=abcdefgh1 b"), (2, "AKIAABCDEFGHIJKL, AKIAABCDEFGHIJKL"), (3, "clean é"), (4, "secret=" + "deadbeef" * 5), (5, None)]
    got = {r["doc_id"]: r for r in redacted(documents(rows)).collect()}
    assert [got[k]["text"] for k in range(1, 6)] == ["a [SECRET] b", "[SECRET], [SECRET]", "clean é", "[SECRET]", None]
    assert got[1]["n_chars"] == len("a [SECRET] b")
    assert redacted(documents(rows)).columns == documents(rows).columns


def test_edges(spark, documents):
    got = scan_secrets(documents(EDGES)).collect()
    assert len(got) == len(EDGES) and {r["spans"] for r in got} == {""}
    assert scan_secrets(documents(EDGES).limit(0)).count() == 0
    assert dict(with_spans(documents(EDGES)).dtypes)["spans"].startswith("array")


def test_main_path_has_no_python(spark, documents):
    plan = scan_secrets(documents(EDGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "NestedLoop" not in plan


def plain_p(token, letters):
    """The battery's p-value with the normal tail of the mathematics library."""
    codes, n, k = [letters.index(c) for c in token], len(token), len(letters)
    tail = lambda z: max(erfc(z / sqrt(2)) / 2, 1e-12)
    chi = sum(codes.count(c) ** 2 for c in range(k)) * k / n - n
    z_chi = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1)))
    ups = [c * 2 >= k for c in codes]
    up, runs = sum(ups), 1 + sum(a != b for a, b in zip(ups, ups[1:], strict=False))
    mean = 1 + 2 * up * (n - up) / n
    z_runs = 8.0 if up in (0, n) else abs(runs - mean) / sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    m = sum(codes) / n
    var = sum((c - m) ** 2 for c in codes)
    z_serial = 8.0 if not var else abs(sum((a - m) * (b - m) for a, b in zip(codes, codes[1:], strict=False)) / var + 1 / n) * sqrt(n)
    half = -(log(tail(z_chi)) + log(min(2 * tail(z_runs), 1.0)) + log(min(2 * tail(z_serial), 1.0)))
    return min(exp(-half) * (1 + half + half * half / 2), 1.0)


def test_p_values_equal_a_plain_version(spark):
    pick, rows = random.Random(11), []
    for name, letters in ALPHABETS.items():
        for k in range(12):
            some = letters if k % 3 else letters[: len(letters) // 2 + 1]
            rows.append((name, "".join(pick.choices(some, k=20 + 7 * k))))
    rows.append(("base62", "a1B" * 30))
    frame = spark.createDataFrame(rows, "name string, token string")
    got = frame.select("name", "token", encoding_of(F.col("token")).alias("e"), p_random(F.col("token"), F.col("name")).alias("p")).collect()
    assert len({r["e"] for r in got}) >= 6
    for r in got:
        assert r["p"] == pytest.approx(plain_p(r["token"], ALPHABETS[r["name"]]), rel=1e-3, abs=1e-6), r


def test_places_of_many_matches(spark):
    text = "".join(f"{'é' * (k % 5)}<{k}>" for k in range(3000)) + "tail"
    frame = spark.createDataFrame([(text,), ("none",), ("",), ("<1>",)], "text string")
    got = frame.select(places(F.col("text"), "<([0-9]+)>", 1).alias("found")).collect()
    for r, t in zip(got, (text, "none", "", "<1>"), strict=True):
        assert [tuple(m) for m in r["found"]] == [(m.start(), m.end(), m[0], m[1]) for m in re.finditer("<([0-9]+)>", t)]


def test_a_token_of_a_megabyte_and_a_text_of_many_tokens(spark, documents):
    pick = random.Random(2)
    letters = ALPHABETS["base64"]
    huge = "".join(pick.choices(letters, k=1_000_000))
    many = " ".join("".join(pick.choices(letters, k=24)) for _ in range(20_000))
    begun = time.time()
    got = {r["doc_id"]: r for r in scan_secrets(documents([(1, huge), (2, many), (3, "a" * 19 + "1")])).collect()}
    assert got[1]["spans"] == f"random:0:{len(huge)}" and got[2]["n_random"] > 15_000 and got[3]["spans"] == ""
    assert len(re.findall(TOKEN, many)) >= got[2]["n_random"]
    assert time.time() - begun < 120
