"""What the two learnt scorers share: bounded training samples and feature columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def balanced(labelled: DataFrame, per_class: int, id_col: str = "id", counted: DataFrame | None = None) -> DataFrame:
    """About `per_class` rows of label 0 and of label 1, picked by a hash of the id, with the `weight`
    that gives each class back its share. All rows where a class has fewer. Classes are as large as in
    `counted`, if the rows to learn from are other rows than those to pick from."""
    sized = labelled if counted is None else counted
    sizes = {r["label"]: r["count"] for r in sized.groupBy("label").count().collect()}
    part = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(11)), F.lit(1_000_000))
    keep, weight = F.lit(False), F.lit(1.0)
    for label, size in sorted(sizes.items()):
        share = min(1.0, per_class / size)
        keep = keep | ((F.col("label") == label) & (part < int(share * 1_000_000)))
        weight = F.when(F.col("label") == label, 1 / share).otherwise(weight)
    return labelled.filter(keep).withColumn("weight", weight)


def vector_of(columns: list[Column]) -> Column:
    return array_to_vector(F.array(*[c.cast("double") for c in columns]))
