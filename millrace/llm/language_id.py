"""Language identification by the nearest of several centroids per language.

A text becomes a TF-IDF vector over hashed character n-grams of orders 1 to 3: letters in
lower case, everything else a single space between words. Each order has its own block of
buckets; counts enter by their logarithm, and vectors have length one. The sampled texts of
each language are clustered on the sphere (spherical k-means), and a text gets the language
of the centroid with the highest cosine. It is rejected if that cosine is below the
language's floor, a fraction of the lowest cosines seen among the language's own texts; for
texts shorter than ``FULL_CHARS`` the floor falls with the square root of the length, as
cosines of short texts do.

The model is fit on a bounded sample (``Settings.fit_rows`` per language, about, drawn by a
hash of the id at a rate that follows from counting all rows); every text is then judged
as a whole, in pieces of bounded size.

Defined results: NULL text and text without a letter are ``und`` with score 0 and rejected;
without training rows every text is ``und``; equal cosines go to the language that sorts
first; repeated rows are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.rows import durable, slices

UNKNOWN = "und"

ORDERS = (1, 2, 3)
BLOCK_BITS = 11
BLOCK = 1 << BLOCK_BITS
DIMENSIONS = BLOCK * len(ORDERS)

# Letters and spaces from which on the whole floor applies.
FULL_CHARS = 400

# Characters turned into n-grams at a time.
PIECE_CHARS = 1 << 20

_SPACE = np.uint32(0x20)


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` texts per language (about) are sampled, of the ``max_languages`` most
    frequent languages, since the model is held by every task."""

    fit_rows: int = 800
    centroids: int = 3
    iterations: int = 12
    max_languages: int = 500
    floor_quantile: float = 0.005
    floor_fraction: float = 0.5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # centroid x dimension
    floors: np.ndarray
    idf: np.ndarray


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str) -> np.ndarray | None:
    """Counts by bucket, or None without a letter."""
    letters, counts, carry, any_letter = _letters(), None, np.array([_SPACE], np.uint32), False
    for start in range(0, len(text), PIECE_CHARS):
        piece = text[start : start + PIECE_CHARS].lower()
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = letters[code]
        any_letter = any_letter or bool(letter.any())
        code = np.where(letter, code, _SPACE)
        before = np.empty_like(code)
        before[0] = carry[-1]
        before[1:] = code[:-1]
        code = np.concatenate([carry, code[(code != _SPACE) | (before != _SPACE)]])
        new = len(carry)
        if len(code) == new:
            continue
        if counts is None:
            counts = np.zeros(DIMENSIONS, np.int64)
        hashed = np.zeros(len(code), np.uint32)
        for block, order in enumerate(ORDERS):
            # The n-gram that ends at each place.
            shifted = code[: len(code) - order + 1]
            hashed = (hashed[1:] if order > 1 else hashed) * np.uint32(0x9E3779B1)
            hashed = hashed + shifted * np.uint32(0x85EBCA6B)
            skip = max(0, new - order + 1)
            mixed = hashed[skip:]
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            bucket = (mixed >> np.uint32(32 - BLOCK_BITS)).astype(np.int64)
            at = slice(block * BLOCK, (block + 1) * BLOCK)
            counts[at] += np.bincount(bucket, minlength=BLOCK)
        carry = code[-(max(ORDERS) - 1) :]
    return counts if any_letter else None


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one."""
    rows = np.log1p(counts) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def _sample(train: DataFrame, settings: Settings) -> DataFrame:
    """About ``fit_rows`` different texts of each of the ``max_languages`` most frequent languages.

    Texts are drawn by their content, so ids need not tell rows apart, and a repeated text is
    drawn once.
    """
    content = F.xxhash64(F.lit(settings.seed), "text")
    sizes = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(content).alias("texts"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(settings.max_languages).collect()
    rate = F.lit(0)
    for row in sizes:
        share = min(1.0, settings.fit_rows / max(1, row.texts))
        rate = F.when(F.col("lang") == row.lang, F.lit(math.ceil(1e9 * share))).otherwise(rate)
    drawn = train.filter(F.pmod(content, F.lit(1_000_000_000)) < rate)
    return drawn.groupBy("lang", "text").agg(F.count(F.lit(1)).alias("times")).select("lang", "text")


def _vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        langs, where, values = [], [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            counts = gram_counts(text.as_py())
            if counts is not None:
                langs.append(lang)
                where.append(np.flatnonzero(counts).astype(np.int32))
                values.append(counts[where[-1]].astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(where, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.int32()))],
            names=["lang", "bucket", "n"],
        )


def _cluster(rows: np.ndarray, k: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length one, and each row's own."""
    rng = np.random.default_rng(settings.seed)
    k = min(k, len(rows))
    centres = rows[[int(rng.integers(len(rows)))]]
    while len(centres) < k:  # far seeds
        centres = np.vstack([centres, rows[[int((rows @ centres.T).max(1).argmin())]]])
    own = np.zeros(len(rows), np.int64)
    for _ in range(settings.iterations):
        own = (rows @ centres.T).argmax(1)
        for c in range(k):
            if (own == c).any():
                total = rows[own == c].sum(0)
                centres[c] = total / np.linalg.norm(total)
    return centres, (rows @ centres.T).argmax(1)


def learn(train: DataFrame, settings: Settings = Settings()) -> Model:
    """``train`` has id, text and lang; rows with a NULL text or lang teach nothing."""
    train = train.select("id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    vectors = _sample(train, settings).mapInArrow(_vectorise, "lang string, bucket array<int>, n array<int>")
    vectors = vectors.transform(durable)  # bounded: the sample
    seen = np.zeros(DIMENSIONS)
    for r in vectors.select(F.explode("bucket").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect():
        seen[r.b] = r.n
    idf = np.log((1 + vectors.count()) / (1 + seen)) + 1

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((len(group), DIMENSIONS), np.float32)
        for i, (bucket, n) in enumerate(zip(group["bucket"], group["n"])):
            counts[i, bucket] = n
        # Order of arrival must not matter.
        rows = weighted(counts, idf)
        rows = rows[np.lexsort((rows @ np.arange(1, DIMENSIONS + 1), rows.max(1)))]
        centres, own = _cluster(rows, settings.centroids, settings)
        best = (rows * centres[own]).sum(1)
        floor = settings.floor_fraction * float(np.quantile(best, settings.floor_quantile))
        return pd.DataFrame(
            {"lang": group["lang"].iloc[0], "centre": [c.astype(np.float32).tobytes() for c in centres], "floor": floor}
        )

    found = vectors.groupBy("lang").applyInPandas(fit, "lang string, centre binary, floor double").collect()
    found = sorted(found, key=lambda r: (r.lang, bytes(r.centre)))
    return Model(
        [r.lang for r in found],
        np.array([np.frombuffer(r.centre, np.float32) for r in found], np.float32).reshape(-1, DIMENSIONS),
        np.array([r.floor for r in found]),
        idf.astype(np.float32),
    )


def judge(texts: list[str | None], model: Model) -> tuple[list[str], list[float], list[bool]]:
    langs, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    for i, text in enumerate(texts):
        counts = gram_counts(text) if text and model.languages else None
        if counts is None:
            continue
        cosines = model.centroids @ weighted(counts, model.idf).astype(np.float32)
        best = int(cosines.argmax())
        langs[i] = model.languages[best]
        scores[i] = min(1.0, max(0.0, float(cosines[best])))
        length = counts[:BLOCK].sum()
        rejected[i] = bool(scores[i] < model.floors[best] * min(1.0, math.sqrt(length / FULL_CHARS)))
    return langs, scores, rejected


def predictor(df: DataFrame, model: Model):
    """A column function from text to struct(lang_pred, score, rejected)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType(
        [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    @F.arrow_udf(returnType=kind)
    def predict(texts: pa.Array) -> pa.Array:
        # One text at a time is a Python object; the batch stays in Arrow.
        out = ([], [], [])
        for text in texts:
            for held, value in zip(out, judge([text.as_py()], shared.value)):
                held.extend(value)
        kinds = (pa.string(), pa.float64(), pa.bool_())
        names = ("lang_pred", "score", "rejected")
        return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)

    return predict


def identify(df: DataFrame, model: Model, text: str = "text") -> Column:
    return predictor(df, model)(df[text])


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def known_language(docs: DataFrame, train: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = learn(train, settings)
    return docs.filter(~identify(docs, model)["rejected"])
