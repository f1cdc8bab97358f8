"""Language identification.

Hashed character n-grams weighted by TF-IDF feed a sparse multinomial logistic
regression. It is trained by follow-the-regularised-leader with elastic-net penalties
and its probabilities are calibrated by one temperature.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import framed, mixed, small_batches, stored

#: Bits of a feature's hash, and lengths of the n-grams.
BITS = 16
ORDERS = (1, 2, 3)
#: Labelled documents per language that the regression is fitted on; a quarter of them sets the temperature.
PER_LABEL = 600
#: FTRL-proximal: learning rate, its smoothing, L1 and L2 penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.3, 1.0, 2e-4, 1e-4, 3
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features_of(text: str | None) -> np.ndarray | None:
    """Feature of every n-gram of a text, repeats kept; None without a letter."""
    if not isinstance(text, str) or not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.unique(codes)
    letters = kinds[[unicodedata.category(chr(c)).startswith("L") if c < 0xD800 or c > 0xDFFF else False for c in kinds.tolist()]]
    if not len(letters):
        return None
    # Whatever is no letter separates; runs of separators count once.
    table = np.zeros(int(kinds[-1]) + 1, bool)
    table[letters] = True
    known = table[codes]
    keep = known.copy()
    keep[1:] |= known[:-1]
    codes = np.where(known, codes, 32).astype(np.uint64)[keep]
    codes = np.concatenate(([32], codes, [32])).astype(np.uint64)
    out, h = [], np.zeros(len(codes), np.uint64)
    for k in range(max(ORDERS)):
        if k >= len(codes):
            break
        h = h[: len(codes) - k] * np.uint64(0x100000001B3) + codes[k:] + np.uint64(k + 1)
        if k + 1 in ORDERS:
            out.append((mixed(h) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """How many documents have letters, and in how many of them each feature is.

    Every task adds up its documents; what it hands on has a fixed size whatever it read.
    """
    piece = 1 << 12

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, counts, seen = 0, np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, bool)
        for batch in batches:
            for text in batch["text"]:
                found = features_of(text)
                if found is not None:
                    total += 1
                    seen[:] = False
                    seen[found] = True
                    counts += seen
        at = np.flatnonzero(np.add.reduceat(counts, np.arange(0, len(counts), piece)))
        rows = [(int(k), counts[k * piece : (k + 1) * piece].tolist()) for k in at]
        yield framed([(-1, [total]), *rows], "piece", "counts")

    parts = docs.select("text").mapInPandas(count, "piece int, counts array<long>")
    sums = parts.select("piece", F.posexplode("counts").alias("at", "n")).groupBy("piece", "at").agg(F.sum("n").alias("n"))
    got = sums.where("n > 0").toPandas()  # at most one row per feature
    counts = np.zeros(1 << BITS, np.int64)
    total = int(got.loc[got.piece == -1, "n"].sum())
    got = got[got.piece >= 0]
    counts[(got.piece * piece + got["at"]).to_numpy(np.int64)] = got.n.to_numpy()
    return total, counts


def vector(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their TF-IDF, scaled to length 1."""
    n = np.bincount(found, minlength=len(idf))
    at = np.flatnonzero(n)
    x = np.log1p(n[at]) * idf[at]
    length = np.sqrt((x * x).sum())
    return at, x / length if length else x


@dataclass
class Model:
    """A fitted model: labels, inverse document frequencies, the weights that are not 0, temperature.

    The weights of feature f are ``values[ends[f - 1] : ends[f]]`` for the labels at
    ``at`` in the same places.
    """

    labels: list[str]
    idf: np.ndarray
    ends: np.ndarray
    at: np.ndarray
    values: np.ndarray
    temperature: float

    def logits(self, features: np.ndarray, x: np.ndarray) -> np.ndarray:
        begins = np.where(features > 0, self.ends[features - 1], 0)
        sizes = self.ends[features] - begins
        upto = np.cumsum(sizes)
        places = np.arange(upto[-1]) + np.repeat(begins - upto + sizes, sizes)
        return np.bincount(self.at[places], weights=np.repeat(x, sizes) * self.values[places], minlength=len(self.labels))

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features_of(text)
        if found is None or not self.labels:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*vector(found, self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], targets: list[int], labels: int, features: int) -> np.ndarray:
    """Weights by feature and label of FTRL-proximal over ``rows``, with per-coordinate rates, L1 and L2."""
    z, n = np.zeros((features, labels), np.float32), np.zeros((features, labels), np.float32)

    def weights(at):
        zs, ns = z[at], n[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(PASSES):
        for (at, x), y in zip(rows, targets, strict=True):
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = np.outer(x, p)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(slice(None)).astype(np.float32)


def temperature_of(logits: np.ndarray, targets: np.ndarray) -> float:
    """The temperature of least log loss, among steps of a tenth of an octave."""
    if not len(targets):
        return 1.0
    steps = 2.0 ** np.arange(-5, 3.05, 0.1)
    loss = [-np.log(softmax(logits / t)[np.arange(len(targets)), targets] + 1e-12).mean() for t in steps]
    return float(steps[int(np.argmin(loss))])


def fit(docs: DataFrame, per_label: int = PER_LABEL) -> Model:
    """A model of the rows that :func:`held_out` does not keep.

    Document frequencies cover all their texts. The regression knows all languages and
    sees ``per_label`` documents of each, the first by a hash of their id and text; rows
    equal in both count once. It is fitted in one task, which holds these documents' at
    most ``2 ** BITS`` features each and two 32-bit numbers per language and feature:
    half a megabyte a language.

    Null ids and repeated rows are learned from like others, null languages and texts
    and texts without a letter are not; with nothing to learn from the model has no
    labels. Other columns are not read.
    """
    learn = small_batches(docs).select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")))
    total, counts = document_frequencies(learn)
    idf = np.log((1 + total) / (1 + counts)) + 1
    named = learn.where("lang is not null and text is not null").select("lang", F.xxhash64("doc_id", "text").alias("_h"))
    # One row per language. A share of its hashes that holds twice the sample goes on to be ranked.
    sizes = stored(named.groupBy("lang").agg(F.approx_count_distinct("_h").alias("_of")), "language-sizes")
    labels = sorted(r["lang"] for r in sizes.select("lang").collect())
    place = F.shiftrightunsigned("_h", 11).cast("double") / float(1 << 53)
    near = named.join(F.broadcast(sizes), "lang").where(place * F.col("_of") < 2 * per_label + 50).select("lang", "_h").distinct()
    by_hash = Window.partitionBy("lang").orderBy(place, "_h")
    chosen = near.withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= per_label)
    chosen = stored(chosen.select("lang", "_h"), "language-sample")  # at most per_label rows a label
    hashed = learn.withColumn("_h", F.xxhash64("doc_id", "text"))
    sample = hashed.join(F.broadcast(chosen), ["lang", "_h"], "left_semi").dropDuplicates(["lang", "_h"])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for lang, h, text in zip(batch["lang"], batch["_h"], batch["text"], strict=True):
                found = features_of(text)
                if found is not None:
                    at, x = vector(found, idf)
                    rows.append((lang, h, at.astype(np.int32).tobytes(), x.astype(np.float32).tobytes()))
            yield framed(rows, "lang", "h", "at", "x")

    def train(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["h", "lang"], kind="stable").reset_index(drop=True)
        rows = [(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32).astype(float)) for a, x in zip(table["at"], table["x"], strict=True)]
        number = {lang: k for k, lang in enumerate(labels)}
        targets = [number[lang] for lang in table["lang"]]
        # Features of the sample, numbered among themselves.
        seen = np.unique(np.concatenate([at for at, _ in rows])) if rows else np.empty(0, np.int32)
        rows = [(np.searchsorted(seen, at), x) for at, x in rows]
        aside = [k for k in range(len(rows)) if k % 4 == 3]
        used = [k for k in range(len(rows)) if k % 4 != 3]
        weights = follow_the_leader([rows[k] for k in used], [targets[k] for k in used], len(labels), len(seen))
        logits = np.array([rows[k][1] @ weights[rows[k][0]] for k in aside]).reshape(len(aside), len(labels))
        best = temperature_of(logits, np.array([targets[k] for k in aside], int))
        by, at = np.nonzero(weights)
        ends = np.cumsum(np.bincount(seen[by], minlength=len(idf)))
        parts = (ends.astype(np.int64), at.astype(np.int32), weights[by, at].astype(np.float32))
        return pd.DataFrame([{name: x for name, x in zip(("ends", "at", "values"), (p.tobytes() for p in parts), strict=True)} | {"temperature": best}])

    fitted = (
        sample.select("lang", "_h", "text").mapInPandas(vectors, "lang string, h long, at binary, x binary")
        .groupBy().applyInPandas(train, "ends binary, at binary, values binary, temperature double").first()
    )
    if fitted is None:
        return Model([], idf, np.zeros(len(idf), np.int64), np.empty(0, np.int32), np.empty(0, np.float32), 1.0)
    ends, at, values = (np.frombuffer(bytes(fitted[name]), kind) for name, kind in (("ends", np.int64), ("at", np.int32), ("values", np.float32)))
    return Model(labels, idf, ends, at, values, fitted["temperature"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, in one narrow pass over whole texts.

    Texts that are null, empty or without a letter get ``und`` and 0.0; so does every
    text if nothing labelled could be learned from. The two columns replace any of the
    same name; no other column is looked at.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "_text")]

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([model.predict(t) for t in batch], columns=["lang_pred", "score"])

    small_batches(docs)
    guess = F.pandas_udf(predict, "lang_pred string, score double")
    return docs.select(*kept, guess("text").alias("_got")).select(*kept, "_got.lang_pred", "_got.score")


def predict_languages(docs: DataFrame) -> DataFrame:
    """Fit on part of ``docs`` and predict all: doc_id, held_out, lang_pred, score.

    Rows with a null id may be learned from; repeated rows count as often as they are
    there; an empty table gives an empty result.
    """
    model = fit(docs)
    rows = identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
