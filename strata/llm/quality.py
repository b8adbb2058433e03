"""Quality scores by a sparse ensemble of rules over text statistics.

A random forest of shallow trees on the statistics of labelled documents proposes rules: every path from a
root is a conjunction of comparisons. A lasso logistic regression weighs the rules and drops most of them.
What is left is one Spark column expression over the statistics. The regression goes by proximal Newton steps, each a
lasso least-squares fit: a few dozen jobs, where descent takes one for every look at the loss, some 300 a fit, whose
events and broadcasts fill the driver.

Statistics are computed once, in one pass over whole texts. The model is fitted on a bounded sample, about
`per_class` labelled rows of each class (all of them, where there are fewer). NULL text counts as empty; all
its statistics are 0 and it gets a score like any other. Rows whose label is NULL teach nothing, repeated
rows count as often as they occur. With one class only the score is that class, without labels it is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, utf8
from strata.llm.models import balanced, vector_of
from strata.sources.tables import stage

STATISTICS = (
    "n_bytes", "n_words", "mean_word", "upper", "lower", "digits", "punctuation", "symbols", "exclaims", "bars",
    "blanks", "non_ascii", "byte_entropy", "distinct_words", "repeats", "top_word", "upper_words", "n_lines",
    "distinct_lines", "mean_line", "short_words",
)

PARTS = (0.0, *(0.5**i for i in range(8)))  # of a step, tried together


def _class(chars: str) -> np.ndarray:
    return np.frombuffer(chars.encode(), np.uint8)


UPPER, LOWER = np.arange(65, 91), np.arange(97, 123)
DIGITS, PUNCTUATION, SYMBOLS = np.arange(48, 58), _class(".,;:'\"!?-()"), _class("#$%&*+/<=>@[\\]^_`{|}~")


def statistics_of(text: bytes) -> list[float]:
    size = len(text)
    if not size:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = count / size
    some = share[share > 0]
    words = text.split()
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    per_word = 1 / n if n else 0.0
    return [
        float(size), float(n), sum(map(len, words)) * per_word,
        share[UPPER].sum(), share[LOWER].sum(), share[DIGITS].sum(), share[PUNCTUATION].sum(), share[SYMBOLS].sum(),
        share[33], share[124], share[32], share[128:].sum(), float(-(some * np.log2(some)).sum()),
        len(seen) * per_word, sum(map(eq, words, words[1:])) * per_word, max(seen.values(), default=0) * per_word,
        sum(map(bytes.isupper, words)) * per_word, float(len(lines)),
        len(set(lines)) / len(lines) if lines else 0.0, n / len(lines) if lines else 0.0,
        sum(len(w) <= 3 for w in words) * per_word,
    ]


def statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The `keep` columns and one double column for each of STATISTICS."""
    kept = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], utf8(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics_of(t) for t in batch.column("text").to_pylist()], float)
            columns = found.reshape(-1, len(STATISTICS)).T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), *(pa.array(np.ascontiguousarray(c)) for c in columns)],
                names=[*kept, *STATISTICS],
            )

    types = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept]
    out = map_batches(rows, work, ", ".join([*types, *(f"{s} double" for s in STATISTICS)]))
    return out.toDF(*keep, *STATISTICS)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it above, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        held = F.lit(True)
        for name, above, threshold in self.tests:
            held = held & (F.col(name) > threshold if above else F.col(name) <= threshold)
        return held.cast("double")


@dataclass(frozen=True)
class Model:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + rule.column() * weight
        return 1 / (1 + F.exp(-total))


def _paths(node, tests: dict) -> list[Rule]:
    """Rules of all nodes below one; a later test of the same side of a statistic replaces the earlier."""
    own = [Rule(tuple((name, above, value) for (name, above), value in sorted(tests.items())))] if tests else []
    if node.getClass().getSimpleName() != "InternalNode":
        return own
    name, threshold = STATISTICS[node.split().featureIndex()], node.split().threshold()
    left = _paths(node.leftChild(), tests | {(name, False): threshold})
    return own + left + _paths(node.rightChild(), tests | {(name, True): threshold})


def _margin(weights: np.ndarray, bias: float) -> Column:
    listed = ", ".join(f"{float(w)!r}D" for w in weights)  # one expression: a literal each is a call to the JVM each
    products = F.zip_with("facts", F.expr(f"array({listed})"), lambda fact, weight: fact * weight)
    return F.aggregate(products, F.lit(float(bias)), lambda total, x: total + x)


def _variance(margin: Column) -> tuple[Column, Column]:
    """Probability and its variance; margins beyond 12 count as 12, so that none is zero."""
    p = 1 / (1 + F.exp(-F.greatest(F.least(margin, F.lit(12.0)), F.lit(-12.0))))
    return p, p * (1 - p)


def lassoed(facts: DataFrame, n: int, lasso: float, steps: int = 50, least: float = 1e-7) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise mean logistic loss + lasso * sum of absolute weights, on rows of `label` (0 and 1
    both occur), `weight` and `facts` (n doubles).

    A step solves the lasso least-squares problem that stands for the loss near the weights so far, from sums of one pass,
    and goes as far towards its solution as the true loss falls. It ends when a step gains less than `least` of the loss.
    """
    total, ones = facts.agg(F.sum("weight"), F.sum(F.col("label") * F.col("weight"))).first()
    share = ones / total
    weights, bias, mass = np.zeros(n), float(np.log(share / (1 - share))), total * share * (1 - share)
    for _ in range(steps):
        margin = _margin(weights, bias)
        p, variance = _variance(margin)
        working = facts.select(
            array_to_vector("facts").alias("features"), (F.col("weight") * variance).alias("weight"),
            (margin + (F.col("label") - p) / variance).alias("label"),
        )
        solved = LinearRegression(
            solver="normal", elasticNetParam=1.0, regParam=lasso * total / mass, standardization=False,
            maxIter=1000, tol=1e-9, weightCol="weight",
        ).fit(working)
        goal, goal_bias = solved.coefficients.toArray(), solved.intercept
        parts = F.explode(F.array(*map(F.lit, PARTS))).alias("part")
        margins = facts.select("label", "weight", margin.alias("here"), _margin(goal, goal_bias).alias("there"), parts)
        at = F.col("here") * (1 - F.col("part")) + F.col("there") * F.col("part")
        wrong = F.when(F.col("label") == 1, -at).otherwise(at)
        loss = F.greatest(wrong, F.lit(0.0)) + F.log1p(F.exp(-F.abs(at)))
        tried = margins.groupBy("part").agg(
            F.sum(F.col("weight") * loss).alias("loss"), F.sum(F.col("weight") * _variance(at)[1]).alias("mass")
        ).collect()
        values = {r.part: r.loss / total + lasso * np.abs(weights + r.part * (goal - weights)).sum() for r in tried}
        best = min(values, key=values.get)
        gained = values[0.0] - values[best]
        weights, bias = weights + best * (goal - weights), bias + best * (goal_bias - bias)
        mass = next(r.mass for r in tried if r.part == best)
        if gained <= least * values[best]:
            break
    return weights, float(bias)


def fit(labelled: DataFrame, per_class: int = 8_000, trees: int = 16, depth: int = 3, lasso: float = 1e-3) -> Model:
    """Learn from rows of statistics with `id` and a 0/1 `label`. Rows with a `weight` are a sample already."""
    spark = labelled.sparkSession
    known = labelled.filter(F.col("label").isin(0, 1)).withColumn("label", F.col("label").cast("double"))
    chosen = known if "weight" in known.columns else balanced(known, per_class)
    sample = stage(spark, chosen, "quality-sample").coalesce(1)
    classes = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(classes) < 2:
        return Model((), (), {0.0: -40.0, 1.0: 40.0}.get(classes[0]) if classes else 0.0)
    inputs = sample.select("label", "weight", vector_of([F.col(s) for s in STATISTICS]).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=17, weightCol="weight").fit(inputs)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in _paths(tree._call_java("rootNode"), {})))
    if not rules:
        share = sample.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()[0]
        return Model((), (), float(np.log(share / (1 - share))))
    facts = sample.select("label", "weight", F.array(*[r.column() for r in rules]).alias("facts"))
    weights, bias = lassoed(stage(spark, facts, "quality-facts").coalesce(1), len(rules), lasso)
    live = [i for i in range(len(rules)) if weights[i] != 0]
    return Model(
        tuple(rules[i] for i in live), tuple(float(weights[i]) for i in live), bias
    )


def fit_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = 8_000
) -> Model:
    """`fit` on the documents whose id has a 0/1 `label` in `labels`; only the sample's texts are read closely."""
    known = labels.filter(F.col("label").isin(0, 1)).select(F.col(id_col).alias("id"), "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Sampled once, by the labels that meet a document, so that the weights are those of `fit` on all of them.
    picked = balanced(known, per_class, counted=texts.select("id").join(known, "id"))
    chosen = stage(docs.sparkSession, picked, "quality-chosen")  # its size decides how it is joined
    return fit(statistics(texts.join(chosen, "id"), keep=("id", "label", "weight")), per_class)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of `docs` and `score`, in one pass over the texts."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = _given(docs, names, text_col)
    return found.select(*names, model.score().alias("score")).toDF(*docs.columns, "score")


def _given(docs: DataFrame, names: list[str], text_col: str) -> DataFrame:
    return statistics(docs.toDF(*names), names[docs.columns.index(text_col)], tuple(names))


def kept(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score `least` or more, with their own columns only, whatever these are called."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return _given(docs, names, text_col).filter(model.score() >= least).select(*names).toDF(*docs.columns)
