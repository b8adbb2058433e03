"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, the units behind them and names (capitalised words inside a sentence) become typed placeholders.
Windows of five template tokens are hashed in every whole document and joined by hash with the windows of
the benchmark items. A document holds an item when it has at least half of the item's windows, so a passage
with other numbers, units or names is found as well.

Windows with placeholders are only believed if the slots fit: within one place where the item stands (the windows
of a document and item that lie equally far from the item's; a window belongs to the place with most of them), one value of the item must always meet the same
value of the document and the other way round. Windows with a slot that does not fit are not counted, unless
all their values are the item's own. What is put into or left out of a copy parts it into places that are
judged apart.

The windows of the benchmark are broadcast up to `BROADCAST_ROWS` counted rows (some tens of MB); a larger
benchmark is joined by a shuffle. NULL and empty texts, and items of fewer than five tokens, match nothing.
Equal document rows give one result, as do equal items; rows without an id are kept under a NULL id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.tables import stage

WINDOW = 5
CONTAINED = 0.5
BROADCAST_ROWS = 1_000_000
NUMBER, UNIT, NAME = "\u0001", "\u0002", "\u0003"
UNITS = (
    "km|m|cm|mm|mi|miles?|ft|feet|in|inch(?:es)?|yd|yards?|kg|g|mg|lbs?|oz|tons?|l|ml|gal|gallons?|s|sec|seconds?|"
    "min|minutes?|h|hrs?|hours?|days?|weeks?|months?|years?|%|percent|usd|eur|dollars?|euros?|cents?|kmh|mph|kwh|w|kw|v|c|f"
)
WORD = r"[\p{L}\p{N}_]"


def marked(text: Column) -> Column:
    """Lower-case text in which each slot value carries the mark of its type in front."""
    names = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;] )(?=\p{Lu})", NAME)
    joined = F.regexp_replace(names, r"(?<=\p{N})[.,:/](?=\p{N})", "_")
    numbers = F.regexp_replace(joined, rf"(?<!{WORD})(?=\p{{N}})", NUMBER)
    units = F.regexp_replace(numbers, rf"(?i)({NUMBER}[\p{{N}}_]+)(?: ?{NAME}?)({UNITS})(?!{WORD})", rf"$1 {UNIT}$2")
    percent = F.replace(units, F.lit(UNIT + "%"), F.lit(UNIT + "percent"))
    return F.lower(F.when(text.rlike(r"\p{N}"), percent).otherwise(names))


def _split(text: Column) -> Column:
    return F.filter(F.split(text, rf"[^\p{{L}}\p{{N}}_{NUMBER}{UNIT}{NAME}]+"), lambda t: t != "")


def template(text: Column) -> Column:
    """Template tokens of a marked text; a slot is its bare mark."""
    return _split(F.regexp_replace(text, rf"([{NUMBER}{UNIT}{NAME}]){WORD}+", "$1"))


def values(text: Column) -> Column:
    """The tokens themselves, aligned with the template."""
    return _split(text)


def _windows(tokens: Column) -> Column:
    """Hash of every window, in order."""
    starts = F.when(F.size(tokens) >= WINDOW, F.sequence(F.lit(1), F.size(tokens) - WINDOW + 1))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, WINDOW)))


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", contained: float = CONTAINED,
) -> DataFrame:
    """One row per document and item that it holds: id, item, windows found, windows of the item, `slots`
    (distinct slot pairs) and `containment`."""
    spark = docs.sparkSession
    items = (
        benchmark.select(F.col(item_col).alias("item"), marked(F.col(item_text_col)).alias("marked"))
        .distinct()
        .withColumns({"tokens": template(F.col("marked")), "raw": values(F.col("marked"))})
    )
    # Inside a document the item's first word may look like a name: its first window has both readings.
    opened = items.filter(~F.col("marked").startswith(NAME)).select(
        "item", F.concat(F.lit(NAME), "marked").alias("marked")
    ).withColumns({"tokens": template(F.col("marked")), "raw": values(F.col("marked"))})
    slot = F.array(F.lit(NUMBER), F.lit(UNIT), F.lit(NAME))
    cut = F.posexplode(_windows(F.col("tokens"))).alias("ipos", "hash")
    columns = ["item", "tokens", "raw", cut]
    known = stage(
        spark,
        items.select(*columns).unionByName(opened.select(*columns).filter("ipos = 0")).select(
            "item", "ipos", "hash",
            F.slice("tokens", F.col("ipos") + 1, WINDOW).alias("shape"),
            F.slice("raw", F.col("ipos") + 1, WINDOW).alias("said"),
        ).withColumn("slotted", F.arrays_overlap("shape", slot)),
        "leak-items",
    )
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("row"), F.col(text_col).alias("text")
    )
    tokens = rows.select("id", "row", template(marked(F.col("text"))).alias("tokens"))
    windows = tokens.select("id", "row", F.posexplode(_windows(F.col("tokens"))).alias("pos", "hash"))
    narrow = known.select("hash", "item", "ipos", "slotted")
    if narrow.count() <= BROADCAST_ROWS:
        narrow = F.broadcast(narrow)
    hits = stage(spark, windows.join(narrow, "hash"), "leak-hits")
    plain = hits.filter(~F.col("slotted")).select("id", "row", "item", "ipos").distinct()

    placed = hits.filter("slotted").withColumn("place", F.col("pos") - F.col("ipos"))
    support = placed.groupBy("row", "item", "place").agg(F.count(F.lit(1)).alias("support"))
    most = F.max("support").over(Window.partitionBy("row", "item", "pos"))
    open_hits = stage(
        spark,
        placed.join(support, ["row", "item", "place"]).withColumn("most", most).filter("support = most")
        .select("id", "row", "pos", "item", "ipos", "hash"),
        "leak-places",
    )
    wanted = stage(spark, open_hits.select("row").distinct(), "leak-wanted")  # its size decides how it is joined
    spoken = (
        rows.join(wanted, "row").select("row", values(marked(F.col("text"))).alias("raw")).dropDuplicates(["row"])
    )
    pairs = (
        open_hits.join(spoken, "row")
        .select("id", "row", "item", "ipos", "hash", "pos", F.slice("raw", F.col("pos") + 1, WINDOW).alias("heard"))
        .join(known.filter("slotted").select("item", "ipos", "hash", "shape", "said"), ["item", "ipos", "hash"])
        .select("id", "row", "item", "ipos", "pos", F.explode(F.arrays_zip("shape", "said", "heard")).alias("s"))
        .filter(F.col("s.shape").isin(NUMBER, UNIT, NAME))
        .select(
            "id", "row", "item", "ipos", "pos", (F.col("pos") - F.col("ipos")).alias("place"),
            F.col("s.said").alias("said"), F.col("s.heard").alias("heard"),
        )
    )
    pairs = stage(spark, pairs, "leak-slots")
    met = pairs.select("row", "item", "place", "said", "heard").distinct()
    forth = met.groupBy("row", "item", "place", "said").agg(F.count(F.lit(1)).alias("answers"))
    back = met.groupBy("row", "item", "place", "heard").agg(F.count(F.lit(1)).alias("questions"))
    judged = pairs.join(forth, ["row", "item", "place", "said"]).join(back, ["row", "item", "place", "heard"])
    fitting = (
        judged.groupBy("id", "row", "item", "ipos", "pos")
        .agg(F.max(F.greatest("answers", "questions")).alias("worst"), F.bool_and(F.col("said") == F.col("heard")).alias("own"))
        .filter("worst = 1 OR own").select("id", "row", "item", "ipos").distinct()
    )
    slots = met.select("row", "item", "said", "heard").distinct().groupBy("row", "item").agg(F.count(F.lit(1)).alias("slots"))
    total = known.groupBy("item").agg(F.countDistinct("ipos").alias("item_windows"))
    found = plain.unionByName(fitting).distinct().groupBy("id", "row", "item").agg(F.count(F.lit(1)).alias("windows"))
    return (
        found.join(total, "item")
        .filter(F.col("windows") >= contained * F.col("item_windows"))
        .join(slots, ["row", "item"], "left")
        .select(
            "id", "row", "item", "windows", "item_windows", F.coalesce("slots", F.lit(0)).alias("slots"),
            (F.col("windows") / F.col("item_windows")).alias("containment"),
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, all columns kept."""
    found = leaks(docs, benchmark, id_col, text_col).select("row").distinct()
    bad = stage(docs.sparkSession, found, "leak-rows")
    return docs.join(bad, F.xxhash64(docs[id_col], docs[text_col]) == bad["row"], "left_anti")
