"""Spelling variants by permuterm rotations.

A word is marked at its end and rotated: "cat" gives cat$, at$c, t$ca and $cat. Take the rotation that begins right after
a character and leave that character, now last, away: the rest is a prefix which the word shares with every word that has
another character there, and which is itself a rotation of the word that lacks it. So rotations are sorted by
prefix and last character; each prefix range is scanned once and tells its words their neighbours: words with
one character replaced, and the one word with none in this place.

A range holds at most one word for each character of the alphabet and one without, so it is small whatever
the input. It gives each of its words the number of its neighbours and the commonest of them, not the pairs: rows
are linear in the characters of the distinct words. A word that loses either of two equal neighbouring characters becomes
the same word twice, so an indel counts at the first of equal characters only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from strata.llm.common import settle

LETTERS = r"[A-Za-zÀ-ÿ]"
MARK = "$"
LEAST_LENGTH, LEAST_COUNT = 7, 2
TIMES = 10  # how much commoner than a word its form must be
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (), least: int = LEAST_LENGTH) -> DataFrame:
    """The `keep` columns and `run`: the maximal runs of letters with `least` or more, A-Z in lower case.

    NULL and empty texts have none. Whole texts are read; repeated runs and rows stay."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"({LETTERS}{{{least},}})"), 1)
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.explode(found).alias("run"))
    return rows.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.translate("run", UPPER, LOWER).alias("run")
    )


def counted(words: DataFrame, word: str | Column = "run", least: int = LEAST_COUNT) -> DataFrame:
    """Distinct words with their number `n` of rows, if it is `least` or more. Counts are added before the shuffle."""
    return words.groupBy((F.col(word) if isinstance(word, str) else word).alias("word")).agg(
        F.count(F.lit(1)).alias("n")
    ).filter((F.col("n") >= least) & F.col("word").isNotNull())


def rotations(words: DataFrame) -> DataFrame:
    """prefix, word, n, last, indel: rotations with the last character left away, and, without `last`, whole ones.

    `indel` is false where the character before is the same, so that each indel is told once.
    """
    size = F.char_length("word")
    at = F.col("at")
    around = F.concat(F.expr("substring(word, at + 1)"), F.lit(MARK), F.expr("substring(word, 1, at - 1)"))
    skipped = F.expr("substring(word, at, 1)")
    whole = F.concat(F.expr("substring(word, at)"), F.lit(MARK), F.expr("substring(word, 1, at - 1)"))
    places = words.select("word", "n", F.explode(F.sequence(F.lit(1), size + 1)).alias("at"))
    kinds = F.array(
        F.struct(whole.alias("prefix"), F.lit(None).cast("string").alias("last"), F.lit(True).alias("indel")),
        F.struct(
            F.when(at <= size, around).alias("prefix"), skipped.alias("last"),
            ((at == 1) | (skipped != F.expr("substring(word, greatest(at - 1, 1), 1)"))).alias("indel"),
        ),
    )
    return places.select("word", "n", F.inline(kinds)).filter("prefix IS NOT NULL")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n for distinct words with counts.

    n_near is the number of words that differ by one inserted, deleted or replaced character; form is the
    commonest of them, the first in code-point order among equals, if it is `TIMES` as common as the word.
    """
    prefix = Window.partitionBy("prefix")
    rank = F.struct((-F.col("n")).alias("minus"), "word")  # the least is the commonest
    sorted_ranks = F.sort_array(F.collect_list(F.when(F.col("last").isNotNull(), rank)).over(prefix))
    scanned = rotations(words).withColumns({
        "replaced": sorted_ranks,
        "without": F.max(F.when(F.col("last").isNull(), rank)).over(prefix),
        "longer": F.count_if(F.col("last").isNotNull() & F.col("indel")).over(prefix),
        "first_longer": F.min(F.when(F.col("last").isNotNull() & F.col("indel"), rank)).over(prefix),
    }).filter((F.size("replaced") > 1) | (F.col("without").isNotNull() & (F.size("replaced") > 0)))
    other = F.when(F.get("replaced", F.lit(0))["word"] == F.col("word"), F.get("replaced", F.lit(1))).otherwise(
        F.get("replaced", F.lit(0))
    )
    shorter = F.when(F.col("indel"), F.col("without"))
    is_whole = F.col("last").isNull()
    told = scanned.select(
        "word",
        F.when(is_whole, F.col("longer"))
        .otherwise(F.size("replaced") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).cast("bigint").alias("n_near"),
        F.when(is_whole, F.col("first_longer")).otherwise(F.least(other, shorter)).alias("best"),
    )
    # One more row a word, so that words without neighbours stay and no join is needed.
    alone = words.select("word", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast(told.schema["best"].dataType).alias("best"), "n")
    found = told.withColumn("n", F.lit(None).cast("bigint")).unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    takes = -F.col("best.minus") >= TIMES * F.col("n")
    return found.select(
        "word", "n", "n_near", F.when(takes, F.col("best.word")).alias("form"),
        F.when(takes, -F.col("best.minus")).alias("form_n"),
    )


def with_roots(spark: SparkSession, found: DataFrame) -> DataFrame:
    """Adds `root`: where the forms of a word lead in the end, the word itself without one.

    A form is `TIMES` as common as its word, so a path has at most 19 steps; each round doubles what is walked.
    Few words have a given form (they are its neighbours), so no key of the joins is hot.
    """
    found = settle(found, "variants")
    steps = settle(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.join(ahead, "root", "left")
        if moved.filter("next IS NOT NULL").isEmpty():
            break
        steps = settle(moved.select("word", F.coalesce("next", "root").alias("root")), "variant-roots")
    return found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(spark: SparkSession, words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root for distinct `word` with counts `n`.

    Words must not hold the mark. An empty table gives no rows. Words without neighbours have n_near 0, NULL form and
    form_n, and themselves as root.
    """
    return with_roots(spark, neighbours(settle(words.select("word", "n"), "variant-words")))
