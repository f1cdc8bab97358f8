"""Secret scans with built-in functions only.

Three patterns give the base spans. Further tokens that look encoded are put through a
battery of randomness tests for their inferred encoding: uniform use of the alphabet
(chi-squared), runs above and below its middle, and serial correlation. The combined
p-values go through false-discovery control per length, and tokens whose randomness
stands are spans of the method.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart

# The patterns of the base spans, in the order of their kinds.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGNED = 8

#: A token that the battery looks at, and the share of random tokens that it may turn away.
TOKEN = "(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{20})(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]++={0,2}"
RATE = 0.05
#: Steps per power of ten in which p-values are counted, and the least one told apart.
STEPS, LEAST = 20, 12

# Alphabets of the encodings, in their order.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "base32": UPPER + "234567",
    "upper36": UPPER + DIGITS,
    "lower36": LOWER + DIGITS,
    "base62": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}


PLACES = "array<struct<start:int,end:int,hit:string,part:string>>"


def places(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches of ``pattern``, leftmost without overlap, as (start, end, hit, part) in code points.

    Gaps between matches and matches alternate, so their lengths add up to places. They
    are added up in blocks, whose number is about that of the matches in one: each step
    copies what its block has found so far, not what the text has.
    ``part`` is group ``group`` of the match.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    both = F.zip_with(hits, parts, lambda hit, part: F.struct(hit.alias("hit"), part.alias("part")))

    def gaps(both):
        return F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(both)), both,
            lambda gap, m: F.struct(F.length(gap).alias("gap"), m["hit"].alias("hit"), m["part"].alias("part")),
        )

    def add(done, m):
        begin = done["at"] + m["gap"]
        end = begin + F.length(m["hit"])
        one = F.struct(begin.alias("start"), end.alias("end"), m["hit"].alias("hit"), m["part"].alias("part"))
        return F.struct(end.alias("at"), F.concat(done["found"], F.array(one)).alias("found"))

    def in_block(block, at):
        start = F.struct(at.alias("at"), F.array().cast(PLACES).alias("found"))
        return F.aggregate(block, start, add, lambda done: done["found"])

    def blocks_of(rows):
        width = F.ceil(F.sqrt(F.greatest(F.size(rows), F.lit(1)))).cast("int")
        firsts = F.sequence(F.lit(1), F.greatest(F.size(rows), F.lit(1)), width)
        return F.transform(firsts, lambda k: F.slice(rows, k, width))

    def begins(blocks):
        lengths = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, m: n + m["gap"] + F.length(m["hit"])))
        return F.aggregate(
            lengths, F.array(F.lit(0)), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n))
        )

    def joined(blocks):
        return F.flatten(F.zip_with(blocks, F.slice(begins(blocks), F.lit(1), F.size(blocks)), in_block))

    return let(let(let(both, gaps), blocks_of), joined)


def found_where(may: Column, text: Column, pattern: str, group: int = 0) -> Column:
    """:func:`places`, looked for only where ``may`` holds."""
    return F.when(may & text.rlike(pattern), places(text, pattern, group)).otherwise(F.array().cast(PLACES))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def encoding_of(token: Column) -> Column:
    """Smallest encoding whose alphabet has every character of ``token`` and whose usual classes all occur; else null."""
    lower, upper, digit = (token.rlike(f"[{c}]") for c in ("a-z", "A-Z", "0-9"))
    return (
        F.when(~digit, None)
        .when(token.rlike("^[0-9a-f]+$") & lower, "hex")
        .when(token.rlike("^[A-Z2-7]+$") & upper, "base32")
        .when(token.rlike("^[A-Z0-9]+$") & upper, "upper36")
        .when(token.rlike("^[a-z0-9]+$") & lower, "lower36")
        .when(~(lower & upper), None)
        .when(token.rlike("^[A-Za-z0-9]+$"), "base62")
        .when(token.rlike("^[A-Za-z0-9+/]+$"), "base64")
        .when(token.rlike("^[A-Za-z0-9_-]+$"), "base64url")
    )


def upper_tail(z: Column) -> Column:
    """Chance that a standard normal exceeds ``z`` (Abramowitz and Stegun 26.2.17)."""

    def of(z, t):
        # Coefficients of the approximation.
        series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        tail = F.exp(-z * z / 2) / 2.5066282746310002 * series
        return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(10.0**-LEAST))

    return let(z, lambda z: let(1 / (1 + 0.2316419 * F.abs(z)), lambda t: of(z, t)))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def by_encoding(encoding: Column, values: dict) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), encoding)


def p_random(token: Column, encoding: Column) -> Column:
    """Combined p-value that ``token`` is random in its encoding.

    * uniformity: chi-squared over the alphabet, turned normal by Wilson and Hilferty;
    * runs: Wald and Wolfowitz, above and below the middle of the alphabet, two-sided;
    * serial correlation of neighbouring codes, two-sided.

    The three are combined by Fisher's method; the tail of chi-squared with six degrees
    of freedom has a closed form. The work grows with the length of the token.
    """
    characters = lambda x: F.filter(F.split(x, ""), lambda c: c != "")
    two_sided = lambda z: F.least(2 * upper_tail(z), F.lit(1.0))

    def of_codes(codes, letters):
        n, k = F.length(token).cast("double"), F.length(letters).cast("double")
        tail_of = lambda x: F.slice(x, F.lit(2), F.size(x) - 1)
        head_of = lambda x: F.slice(x, F.lit(1), F.size(x) - 1)
        # How often each letter occurs, by its removal: one pass a letter.
        counts = F.transform(characters(letters), lambda c: n - F.length(F.replace(token, c, F.lit(""))))
        equal = total(F.transform(counts, lambda x: x * x))
        free = k - 1
        z_chi = (F.pow(F.greatest(equal * k / n - n, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        ups = F.transform(codes, lambda c: F.when(c * 2 >= k, 1.0).otherwise(0.0))
        changes = lambda u: total(F.zip_with(head_of(u), tail_of(u), lambda a, b: F.abs(a - b)))
        sides = let(ups, lambda u: F.struct(total(u).alias("up"), (1 + changes(u)).alias("runs")))
        z_runs = let(sides, lambda u: wald_wolfowitz(u["up"], n - u["up"], u["runs"]))
        z_serial = let(total(codes) / n, lambda m: serial(
            total(F.zip_with(head_of(codes), tail_of(codes), lambda a, b: (a - m) * (b - m))),
            total(F.transform(codes, lambda c: (c - m) * (c - m))), n,
        ))
        half = -(F.log(upper_tail(z_chi)) + F.log(two_sided(z_runs)) + F.log(two_sided(z_serial)))
        return let(half, lambda h: F.least(F.exp(-h) * (1 + h + h * h / 2), F.lit(1.0)))

    def of_letters(letters):
        return let(F.transform(characters(token), lambda c: F.position(c, letters).cast("double") - 1), lambda codes: of_codes(codes, letters))

    return let(by_encoding(encoding, ALPHABETS), of_letters)


def wald_wolfowitz(up: Column, down: Column, runs: Column) -> Column:
    """How far the runs are off their mean, in deviations; far off if one side is empty."""
    n = up + down
    mean = 1 + 2 * up * down / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    return F.when((up == 0) | (down == 0), 8.0).otherwise(F.abs(runs - mean) / F.sqrt(F.greatest(var, F.lit(1e-9))))


def serial(co: Column, var: Column, n: Column) -> Column:
    """Correlation of neighbours in deviations from its mean -1/n; far off if all are equal."""
    return F.when(var == 0, 8.0).otherwise(F.abs(co / F.greatest(var, F.lit(1e-9)) + 1 / n) * F.sqrt(n))


def tested(text: Column) -> Column:
    """Tokens of ``text`` with an inferred encoding: (start, end, n, p)."""

    def test(m):
        body = F.regexp_replace(m["hit"], "=+$", "")
        return let(body, lambda b: let(encoding_of(b), lambda e: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), F.length(b).alias("n"), F.when(e.isNotNull(), p_random(b, e)).alias("p"),
        )))

    return F.filter(F.transform(found_where(F.lit(True), text, TOKEN), test), lambda t: t["p"].isNotNull())


def step_of(p: Column) -> Column:
    """Place of a p-value among :data:`STEPS` steps per power of ten, least first."""
    return F.least(F.greatest(F.ceil((F.log10(F.greatest(p, F.lit(10.0**-LEAST))) + LEAST) * STEPS), F.lit(0)), F.lit(LEAST * STEPS)).cast("int")


def length_band(n: Column) -> Column:
    """Powers of the square root of two: short tokens have little power, so they are controlled among themselves."""
    return F.floor(F.log2(n.cast("double")) * 2).cast("int")


def turned_away(tests: DataFrame, rate: float = RATE) -> dict[int, int]:
    """For each length band with a discovery, the last step whose tokens are turned away as not random.

    ``tests`` has n and p. Benjamini and Hochberg over all tokens of a band, so at most
    ``rate`` of what is turned away is random. P-values are counted by step and taken at
    the step's upper end: what reaches the driver is one row per band and step.
    """
    counts = tests.groupBy(length_band(F.col("n")).alias("band"), step_of(F.col("p")).alias("step")).count().collect()
    last: dict[int, int] = {}
    for band in sorted({r["band"] for r in counts}):
        steps = sorted((r["step"], r["count"]) for r in counts if r["band"] == band)
        everything, rank = sum(n for _, n in steps), 0
        for step, n in steps:
            rank += n
            if 10 ** (step / STEPS - LEAST) * everything <= rank * rate:
                last[band] = step
    return last


def with_spans(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` with ``spans``: array of (start, end, kind) in code points, end exclusive, by start, then kind.

    ``kind`` counts :data:`KINDS` from 0. Base spans are whole matches. A token of the
    battery that overlaps a base span is no span of its own. Null and empty texts have no
    spans; each row is judged for itself, so null or repeated ids do not matter; a column
    named spans is replaced. The corpus is scanned for the tests of all tokens and again
    for the result; only counts by band and step are shuffled.
    """
    kept = [c for c in docs.columns if c not in ("spans", "_base", "_tests")]
    text = F.coalesce(F.col("text"), F.lit(""))
    last = turned_away(docs.select(F.explode(tested(text)).alias("t")).select("t.n", "t.p"), rate)
    low = F.lower(text)
    may = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    assigned = F.filter(found_where(may, text, ASSIGN, 2), lambda m: F.length(m["part"]) >= MIN_ASSIGNED)
    by_kind = (assigned, found_where(text.contains("AKIA"), text, ACCESS), found_where(F.lit(True), text, HEX))

    def span(kind):
        return lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"))

    base = F.concat(*(F.transform(found, span(kind)) for kind, found in enumerate(by_kind)))
    rows = docs.select(*kept, base.alias("_base"), tested(text).alias("_tests"))
    limits = F.create_map(*(F.lit(x) for pair in (last or {-1: -1}).items() for x in pair))
    random = F.filter(
        "_tests",
        lambda t: (step_of(t["p"]) > F.coalesce(F.element_at(limits, length_band(t["n"])), F.lit(-1)))
        & ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    return rows.select(*kept, F.array_sort(F.concat("_base", F.transform(random, span(KINDS.index("random"))))).alias("spans"))


def named(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Digest of :func:`with_spans`: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    rows = with_spans(docs.select("doc_id", "text"), rate)
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("random"))
    return rows.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"), of_kind(3).alias("n_random"),
        F.sha2(named(base).cast("binary"), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", rate: float = RATE) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans become one mark.

    ``n_chars``, if there is such a column, follows the text; all other columns stay as
    they are, whatever their names.
    """
    return apart(docs, ("text", "n_chars"), lambda rows: _redacted(rows, mark, rate))


def _redacted(docs: DataFrame, mark: str, rate: float) -> DataFrame:
    text = F.col("text")

    def cut(done, s):
        fresh = s["start"] >= done["at"]
        out = F.when(fresh, F.concat(done["out"], F.substr(text, done["at"] + 1, s["start"] - done["at"]), F.lit(mark))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", start, cut, lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1)))
    rows = with_spans(docs, rate).withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(text))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
