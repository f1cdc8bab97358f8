"""Mixing sources to target weights.

Tokens are added up per source, targets follow from weights, and every document is
taken ``floor(rate)`` times plus one more with the probability of the fraction: a
Bernoulli draw, seeded by a hash of its id and text. Each source has several independent
series of such draws and uses the one that brings its words nearest to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.operators.keys import dense_surrogate_key

from .common import stored

WORD = "[^\\x20\\x09-\\x0D]+"
#: Seed of the draws, and the hex digits of a hash that make one (52 bits, which a double holds exactly).
SEED, DIGITS = 0, 13
#: Independent series of draws; a source uses the one that brings it nearest its target.
DRAWS = 8


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2
) -> DataFrame:
    """``totals`` (source, source_size) with a ``target`` each.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share[0] / share[1]`` of all sizes. A target stops at ``most`` times its source's
    size and the excess is shared again by weight until no target is above. Each round
    is one sum over the sources; integers keep it exact.
    """
    above, below = share
    if totals.isEmpty():
        return totals.select("*", F.lit(0.0).alias("target"))
    ordered = dense_surrogate_key(totals.select("*", F.col("source").isNull().alias("_last")), ["_last", "source"], "_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    rows = stored(ordered.select("source", "source_size", weight.cast("long").alias("_w")), "mix-sources")
    everything = rows.agg(F.sum("source_size")).first()[0] or 0
    rest, per = everything * above, 0
    stop = F.lit(False)
    while True:
        sums = rows.agg(
            F.sum(F.when(stop, F.col("source_size"))).alias("full"), F.sum(F.when(~stop, F.col("_w"))).alias("open")
        ).first()
        rest, per = everything * above - below * most * (sums["full"] or 0), below * (sums["open"] or 0)
        now = stop | (F.col("source_size") * F.lit(most * per) < F.col("_w") * F.lit(rest)) if per else stop
        if not per or rows.where(now & ~stop).isEmpty():
            break
        full = rows.where(now).agg(F.max(F.col("source_size") / F.col("_w"))).first()[0]
        stop = F.col("source_size") / F.col("_w") <= F.lit(full)
    even = F.col("_w") * F.lit(rest) / F.lit(float(per or 1))
    return rows.select(
        "source", "source_size", F.when(stop, (F.col("source_size") * most).cast("double")).otherwise(even).alias("target")
    )


def digest(text: Column) -> Column:
    """What a draw knows of a text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def chance(doc_id: Column, text: Column, seed: Column | int = SEED) -> Column:
    """A number in [0, 1) that only the seed, the id and the text decide; nulls count as empty."""
    return _chance(doc_id, digest(text), seed)


def _chance(doc_id: Column, seen: Column, seed: Column | int) -> Column:
    number = F.lit(seed) if isinstance(seed, int) else seed
    mark = F.concat_ws(":", number.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), seen)
    return F.conv(F.substr(F.md5(mark.cast("binary")), F.lit(1), F.lit(DIGITS)), 16, 10).cast("double") / float(16**DIGITS)


def _copies(rate: Column, drawn: Column) -> Column:
    return F.floor(rate) + (drawn < rate - F.floor(rate)).cast("long")


def mix(docs: DataFrame, weights=(3, 1, 2), share=(3, 2), most: int = 2, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken.

    ``docs`` needs doc_id, source and text; other columns of it stay unless they bear
    one of the names given here, which are replaced. Null texts have size 0, null
    sources are one source, sources without words get target 0 and no copies. Repeated
    rows are counted like any others; rows equal in id and text share their draw, others
    have draws of their own, with or without an id. Each of :data:`DRAWS` series has its
    source's target as the mean of its words, and a source uses the series that comes
    nearest, the first of equals. An empty table gives an empty one. Texts are read
    twice and never shuffled unless there are more sources than a broadcast holds.
    """
    made = ("size", "source_size", "target", "copies", "taken")
    kept = [c for c in docs.columns if c.lower() not in made]
    slim = docs.select(
        F.col("source").alias("_source"), F.col("doc_id").cast("string").alias("_id"), word_count(F.col("text")).alias("_size"),
        digest(F.col("text")).alias("_seen"),
    )
    slim = stored(slim, "mix-sizes")
    totals = stored(slim.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size")), "mix-totals")
    targets = source_targets(totals, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = stored(targets.withColumn("_rate", rate), "mix-targets")
    met = slim.join(targets, F.col("_source").eqNullSafe(F.col("source")))
    seeds = range(seed * DRAWS, seed * DRAWS + DRAWS)
    words = {s: F.col("_size") * _copies(F.col("_rate"), _chance(F.col("_id"), F.col("_seen"), s)) for s in seeds}
    sums = met.groupBy("source", "source_size", "target", "_rate").agg(*(F.sum(n).alias(f"_sum{s}") for s, n in words.items()))
    nearest = F.array_min(F.array(*(F.struct(F.abs(F.col(f"_sum{s}") - F.col("target")).alias("off"), F.lit(s).alias("seed")) for s in seeds)))
    picked = stored(sums.select(F.col("source").alias("_of"), "source_size", "target", "_rate", nearest["seed"].alias("_seed")), "mix-picked")
    out = docs.alias("d").join(picked.alias("m"), F.col("d.source").eqNullSafe(F.col("m._of")))
    out = out.select(
        *(F.col(f"d.`{c}`") for c in kept), word_count(F.col("d.text")).alias("size"), "m.source_size", "m.target",
        _copies(F.col("m._rate"), chance(F.col("d.doc_id"), F.col("d.text"), F.col("m._seed"))).alias("copies"),
    )
    return out.select(*(F.col(f"`{c}`") for c in kept), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def emitted(mixture: DataFrame) -> DataFrame:
    """Every document of :func:`mix` as often as it is taken, numbered by ``copy`` from 1."""
    rows = mixture.where("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
