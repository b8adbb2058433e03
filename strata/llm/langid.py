"""Language identification by nearest centroids of TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one blank, and n-grams of one to four code points are
hashed into a fixed number of buckets. A vector is log-scaled term frequency times inverse document
frequency, of length one. Every language gets several centroids by spherical k-means, and a text goes to the
language of the closest one; `rejected` marks texts farther from it than nearly all training texts of that
language are.

The model is fitted on a bounded sample: about `per_language` training rows of each language (all of them,
where there are fewer), chosen by a hash of their text. It is a few hundred kilobytes and travels with the
tasks. Text that is NULL or has no letter is `und` with score 0; a tie goes to the language that sorts
first. Long texts are counted piece by piece. Rows without a language are not learnt from; without any
training row every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches

UNKNOWN = "und"
LENGTHS = (1, 2, 3, 4)
BUCKETS = 1 << 12
PIECE = 1 << 18  # characters counted at once


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # centroids x buckets, weighted by idf already
    idf: np.ndarray
    floor: dict[str, float]  # similarity below which a text is rejected


def counts(text: str) -> np.ndarray:
    """n-gram counts of a text by bucket."""
    total = np.zeros(BUCKETS, np.int64)
    overlap = max(LENGTHS) - 1
    for start in range(0, max(1, len(text)), PIECE):
        piece = text[max(0, start - overlap) : start + PIECE].lower()
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        # Letters outside ASCII are all code points from U+00AA on but a few signs.
        letter = (points >= 0xAA) & (points != 0xD7) & (points != 0xF7) | (points >= 97) & (points <= 122)
        points = np.where(letter, points, 32)
        points = np.concatenate(([32], points, [32])).astype(np.uint32)
        points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
        grams = points
        for n in range(1, max(LENGTHS) + 1):
            if n > 1:
                grams = (grams[:-1] * np.uint32(0x01000193)) ^ points[n - 1 :]
            if not len(grams):
                break
            total += np.bincount((grams * np.uint32(0x9E3779B1)) >> np.uint32(20), minlength=BUCKETS)
    return total


def vector(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(found) * idf
    length = np.sqrt((weighted**2).sum())
    return weighted / length if length else weighted


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """About `per_language` different texts of every language, picked by hash; all of them if there are no more.

    Copies of a text count once, so a language of few texts with many copies keeps its texts, and copies cannot
    make the sample larger."""
    hashed = labelled.withColumn("hash", F.xxhash64("text", F.lit(7)))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("hash", 0.02).alias("texts")).collect()  # a row a language
    part = F.pmod("hash", F.lit(1_000_000))
    keep = F.lit(False)
    for row in sorted(sizes):
        # The estimate may be a few per cent off, so a language close to the bound is taken whole.
        share = 1.0 if row["texts"] <= 1.1 * per_language else per_language / row["texts"]
        keep = keep | ((F.col("lang") == row["lang"]) & (part < int(share * 1_000_000)))
    return hashed.filter(keep).groupBy("lang", "hash").agg(F.first("text").alias("text")).drop("hash")


def _kmeans(points: np.ndarray, groups: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from far-apart seeds; deterministic."""
    seeds = [0]
    for _ in range(1, min(groups, len(points))):
        seeds.append(int((points @ points[seeds].T).max(axis=1).argmin()))
    centres = points[seeds].copy()
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        for g in range(len(centres)):
            mean = points[nearest == g].sum(axis=0) if (nearest == g).any() else centres[g]
            centres[g] = mean / (np.sqrt((mean**2).sum()) or 1)
    return centres


def fit(
    train: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 600, groups: int = 4,
    rejected_share: float = 0.001,
) -> Model:
    """Learn from all rows of `train` that have a text with a letter and a language (bounded sample)."""
    labelled = train.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.filter(has_letter(F.col("text")) & F.col("lang").isNotNull())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(t).astype("<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(found, pa.binary())], names=["lang", "counts"]
            )

    sample = _sample(labelled, per_language)
    rows = sorted(map_batches(sample, work, "lang string, counts binary").collect())
    if not rows:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.ones(BUCKETS, np.float32), {})
    found = np.stack([np.frombuffer(r["counts"], "<u4") for r in rows]).astype(np.float32)
    idf = (np.log((1 + len(found)) / (1 + (found > 0).sum(axis=0))) + 0.05).astype(np.float32)
    vectors = np.log1p(found) * idf
    vectors /= np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), 1e-9)
    names, centres, floor = [], [], {}
    owners = np.array([r["lang"] for r in rows])
    for language in sorted(set(owners)):
        own = vectors[owners == language]
        middle = _kmeans(own, groups)
        names += [language] * len(middle)
        centres.append(middle)
        floor[language] = float(np.quantile((own @ middle.T).max(axis=1), rejected_share))
    return Model(names, np.concatenate(centres).astype(np.float32), idf, floor)


def predict(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The `keep` columns, `lang_pred`, `score` (cosine with the closest centroid) and `rejected`."""
    kept = [f"k{i}" for i in range(len(keep))]
    rows = df.select(
        *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)],
        F.when(has_letter(F.col(text_col)), F.col(text_col)).alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores, rejected = [], [], []
            for text in batch.column("text").to_pylist():
                if text is None or not model.languages:
                    languages.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                close = model.centroids @ vector(counts(text), model.idf).astype(np.float32)
                best = int(close.argmax())
                score = min(1.0, max(0.0, float(close[best])))
                languages.append(model.languages[best]), scores.append(score)
                rejected.append(score < model.floor[model.languages[best]])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), pa.array(languages, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    types = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept]
    out = map_batches(rows, work, ", ".join([*types, "lang_pred string, score double, rejected boolean"]))
    return out.toDF(*keep, "lang_pred", "score", "rejected")
