import random

from stratamart.llm.licenses import PHRASES, TEMPLATES, Automaton, Scanner, scan_licenses, words_of

from .conftest import EDGES


def test_matching_statistics_equal_brute_force():
    pick = random.Random(2)
    for _ in range(40):
        sequences = [[b"%d" % pick.randrange(3) for _ in range(pick.randrange(1, 12))] for _ in range(3)]
        text = [b"%d" % pick.randrange(4) for _ in range(40)]
        runs = {tuple(s[i:j]): set() for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for k, s in enumerate(sequences):
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    runs[tuple(s[i:j])].add((k, j))
        automaton = Automaton(sequences)
        got = {place: (length, set(automaton.ends[state])) for place, length, state in automaton.statistics(text)}
        for place in range(len(text)):
            best = max((n for n in range(1, place + 2) if tuple(text[place + 1 - n : place + 1]) in runs), default=0)
            if best:
                assert got[place] == (best, runs[tuple(text[place + 1 - best : place + 1])])
            else:
                assert place not in got or got[place][0] == 0


def test_base_places_equal_brute_force():
    pick, parts = random.Random(4), ["mit", "apache", "license", "general", "public", "the", "MIT", "license,", "é"]
    scanner = Scanner()
    for _ in range(60):
        text = " ".join(pick.choices(parts, k=60))
        w = words_of(text)
        expected = sorted((i, label) for phrase, label in PHRASES for p in [words_of(phrase)] for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p)
        assert sorted(scanner.scan(text)[1]) == expected


def test_templates_are_found_in_pieces(spark, documents):
    long = [(k, t) for k, (_, t) in enumerate(TEMPLATES)]
    got = {r["doc_id"]: r for r in scan_licenses(documents(long)).collect()}
    assert all(TEMPLATES[k][0] in r["labels"].split(",") and r["score"] == 1.0 for k, r in got.items())
    bsd = dict(TEMPLATES)["bsd"].split()
    broken = "word " * 9 + " ".join(bsd[:8]) + " x y " + " ".join(bsd[8:]) + " end"
    row = scan_licenses(documents([(1, broken)])).first()
    assert row["labels"] == "bsd" and row["base_labels"] == "" and row["n_base"] == 0 and row["first_word"] is None
    assert (row["spans"][0]["start"], row["spans"][0]["end"]) == (9, 9 + len(bsd) + 2)
    assert scan_licenses(documents([(1, "licensed under the terms of use")])).first()["labels"] == ""


def test_edges(spark, documents):
    got = scan_licenses(documents(EDGES)).collect()
    assert len(got) == len(EDGES) and {r["labels"] for r in got} == {""}
    assert scan_licenses(documents(EDGES).limit(0)).count() == 0
