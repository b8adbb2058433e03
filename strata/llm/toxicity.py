"""Toxicity by gradient-boosted trees over a few dense features, calibrated by isotonic regression.

Features of a whole text: density, number and variety of lexicon words, how near they stand to a
second-person word, capitals, punctuation, and obfuscated words (letters replaced by signs or digits).

The lexicon is a short list of plain insults plus word stems learnt from the labels: stems that occur
in far more toxic than other documents, in any language. Stems, trees and calibration are fitted on a bounded
sample of labelled rows, about `per_class` of each class (all of them, where there are fewer); the trees
see two thirds of it and the calibration the rest. The lexicon is at most `LEXICON` stems.

NULL text is empty. Rows whose label is NULL teach nothing; repeated rows count as often as they occur. With
one class only the score is that class; without labels it is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches
from strata.llm.models import balanced, vector_of
from strata.sources.tables import stage

# Fixed values.
INSULTS = frozenset("""
idiot idiots moron morons stupid loser losers clown clowns scum trash garbage worthless pathetic disgusting dumb
fool fools jerk jerks vermin filth freak freaks hate
""".split())
SECOND_PERSON = frozenset("""
you your yours yourself u ur du dich dir dein deine deinen ihr euch tu te ti tú tus vos usted ustedes vous votre vos toi ton ta
""".split())
LEET = str.maketrans("01345789@$!|*+", "oieastbgasiiat")
WORD = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"(?<!\S)[^\W\d_]*[0134578@$!|*+]+[^\W\d_]+[0134578@$!|*+]*[^\W\d_]*")

LEXICON = 2_000
STEMS = (4, 5, 6)
NEAR = 5
FEATURES = (
    "words", "insults", "insult_density", "stems", "stem_density", "stem_weight", "stem_kinds", "near_you",
    "second_person", "capitals", "upper_words", "exclaims", "punctuation", "masked", "masked_hits",
)


@dataclass(frozen=True)
class Lexicon:
    stems: dict[str, float]

    def weight(self, word: str) -> float:
        """Of the heaviest stem the word begins with, or of the word itself."""
        found = self.stems.get("=" + word, 0.0)
        for n in STEMS:
            found = max(found, self.stems.get(word[:n], 0.0)) if len(word) >= n else found
        return found


class _Weights(dict):
    """Weights of words seen so far: (lexicon weight, is it an insult, is it second person)."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[float, bool, bool]:
        found = (self.lexicon.weight(word), word in INSULTS, word in SECOND_PERSON)
        self[word] = found
        return found


def features_of(text: str, weights: _Weights) -> list[float]:
    lower = text.lower()
    words = WORD.findall(lower)
    n = len(words)
    per = 1 / n if n else 0.0
    insults, stems, total, kinds, you, hits = 0, 0, 0.0, set(), [], []
    for i, found in enumerate(map(weights.__getitem__, words)):
        if found[0] or found[1]:
            hits.append(i)
            insults += found[1]
            stems += found[0] > 0
            total += found[0]
            kinds.add(words[i][:5])
        if found[2]:
            you.append(i)
    near = 0
    if hits and you:
        after = np.searchsorted(you, hits)
        gap = np.minimum(
            np.abs(np.take(you, np.minimum(after, len(you) - 1)) - hits), np.abs(np.take(you, np.maximum(after - 1, 0)) - hits)
        )
        near = int((gap <= NEAR).sum())
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    count = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    masked = MASKED.findall(lower) if count[[48, 49, 51, 52, 53, 55, 56, 64, 36, 33, 124, 42, 43]].any() else []
    plain = [weights[m.translate(LEET)] for m in masked]
    return [
        np.log1p(n), np.log1p(insults), insults * per, np.log1p(stems), stems * per, total * per, float(len(kinds)),
        near * per, len(you) * per, count[65:91].sum() / size,
        sum(map(str.isupper, text.split())) * per, count[33] / size,
        count[[46, 44, 59, 58, 63, 45]].sum() / size, len(masked) * per, float(sum(p[0] > 0 or p[1] for p in plain)),
    ]


def features(df: DataFrame, lexicon: Lexicon, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The `keep` columns and one double column for each of FEATURES."""
    kept = [f"k{i}" for i in range(len(keep))]
    rows = df.select(
        *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)],
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(lexicon)
        for batch in batches:
            if len(weights) > 500_000:
                weights.clear()
            found = np.array([features_of(t, weights) for t in batch.column("text").to_pylist()], float)
            columns = found.reshape(-1, len(FEATURES)).T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                names=[*kept, *FEATURES],
            )

    types = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept]
    out = map_batches(rows, work, ", ".join([*types, *(f"{f} double" for f in FEATURES)]))
    return out.toDF(*keep, *FEATURES)


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Stems far more frequent in documents of label 1, from a bounded sample (text, label)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                words = set(WORD.findall((text or "").lower()))
                for stem in {w[:n] for w in words for n in STEMS if len(w) >= n} | {"=" + w for w in words}:
                    seen.setdefault(stem, [0, 0])[int(label)] += 1
        zeros, ones = ([v[i] for v in seen.values()] for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(zeros, pa.int64()), pa.array(ones, pa.int64())],
            names=["stem", "other", "toxic"],
        )

    counts = map_batches(sample.select("text", "label"), work, "stem string, other bigint, toxic bigint")
    sizes = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, other = F.col("toxic") + 0.5, F.col("other") + 0.5
    odds = F.log(toxic / (sizes[1] + 1 - toxic)) - F.log(other / (sizes[0] + 1 - other))
    error = F.sqrt(1 / toxic + 1 / other)
    best = (
        counts.groupBy("stem").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        .filter(F.col("toxic") >= 3)
        .select("stem", odds.alias("odds"), (odds / error).alias("z"))
        .filter("odds > 2.5 AND z > 2.6")
        .orderBy(F.desc("z"), "stem")
        .limit(LEXICON)
    )
    return Lexicon({r["stem"]: float(r["odds"]) for r in best.collect()})


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    trees: object = None
    calibration: object = None
    constant: float = 0.5

    def score(self, df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
        """The `keep` columns and `score`."""
        found = features(df, self.lexicon, text_col, keep)
        if self.trees is None:
            return found.select(*keep, F.lit(self.constant).alias("score"))
        margin = _margin(self.trees, found, list(keep))
        return self.calibration.transform(margin).select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"))


def _margin(trees, found: DataFrame, keep: list[str]) -> DataFrame:
    rows = found.select(*keep, vector_of([F.col(f) for f in FEATURES]).alias("features"))
    return trees.transform(rows).select(*keep, vector_to_array("rawPrediction")[1].alias("margin"))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = 4_000,
    rounds: int = 20, depth: int = 3,
) -> Model:
    """Learn from the texts of `docs` whose id has a 0/1 `label` in `labels`."""
    spark = docs.sparkSession
    known = labels.filter(F.col("label").isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col("label").cast("double").alias("label")
    )
    # The sample of labels is bounded, so it goes to the texts and not the texts to it.
    chosen = F.broadcast(balanced(known, per_class))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = stage(spark, texts.join(chosen, "id"), "toxic-sample")
    classes = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(classes) < 2:
        return Model(Lexicon({}), constant=classes[0] if classes else 0.5)
    calibrating = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(23)), F.lit(3)) == 0
    lexicon = learn_lexicon(sample.filter(~calibrating))
    keep = ("id", "label", "weight")
    rows = stage(spark, features(sample, lexicon, keep=keep), "toxic-features").coalesce(1)
    # Little data is used twice rather than calibrated on next to nothing.
    held = rows.filter(calibrating & (F.col("label") == 1)).count() >= 200
    learning = rows.filter(~calibrating) if held else rows
    inputs = learning.select("label", "weight", vector_of([F.col(f) for f in FEATURES]).alias("features"))
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=17, weightCol="weight").fit(inputs)
    margins = _margin(trees, rows.filter(calibrating) if held else rows, ["label", "weight"])
    calibration = IsotonicRegression(featuresCol="margin", weightCol="weight", predictionCol="score").fit(margins)
    return Model(lexicon, trees, calibration)
