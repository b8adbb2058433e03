"""The registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    ann, bpe, chat, decontaminate, langid, lm, packing, periodic, quality, simhash, suffixes, toxicity, variants,
)
from strata.llm.common import is_held_out, read, remainder
from strata.sources.tables import stage

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PASSAGE_WORDS = 51
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", is_held_out("doc_id", 5, 0))
    model = langid.fit(docs.filter(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return langid.predict(docs, model, keep=("doc_id", "held_out"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", is_held_out("doc_id", 5, 0))
    facts = stage(spark, quality.statistics(docs, keep=("doc_id", "held_out")), "quality-statistics")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(facts.filter("NOT held_out").join(labels, "doc_id").withColumnRenamed("doc_id", "id"))
    scored = facts.select("doc_id", "held_out", model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", is_held_out("doc_id", 3, 1))
    labels = read(spark, sf_dir, "labels").filter(~is_held_out("doc_id", 3, 1))
    model = toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    scored = model.score(docs, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(read(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, keep=("doc_id",))
    return bpe.decode(ids, RANKS).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "windows", "item_windows", "slots", "containment"
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L AS conv_id, * FROM VALUES (0L, 'user', '{said}'), (1L, 'assistant', '{said}') AS t(turn, role, text)")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.render(chat.fold(chat.log_of(turns))))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns are about strings of 400 bytes. `n_passages` and `passage_bytes` list, beside them, the
    repeated passages of over 50 words, which may be shorter than that and stay in the text."""
    left = suffixes.without_repeats(read(spark, sf_dir, "documents"), list_words=PASSAGE_WORDS)
    total = lambda spans: F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return left.select(
        F.col("id").alias("doc_id"), "n_bytes", total("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.size("passages").cast("long").alias("n_passages"), total("passages").alias("passage_bytes"),
    )


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = lm.score(docs, remainder("doc_id", 7) != 2, is_held_out("doc_id", 7, 2))
    return scored.withColumnRenamed("id", "doc_id")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), packing.LibraryIds(TOKENIZER, 0))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of texts, of which those with crc32(doc_id) divisible by ten are made periodic from a word on.

    A NULL doc_id has no crc32 and leaves its text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    sized = split.withColumn("n", F.nullif(F.size("words"), F.lit(0)))
    placed = sized.withColumn("a", F.expr("CAST(g % n AS INT)"))
    turned = placed.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    again = F.expr("flatten(array_repeat(slice(words, a + 1, p), CAST(ceil((n - a) / p) AS INT)))")
    made = F.array_join(F.concat(F.expr("slice(words, 1, a)"), F.slice(again, F.lit(1), F.expr("n - a"))), " ")
    texts = turned.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))
    found = periodic.with_runs(texts, keep=("doc_id",)).withColumn("best", periodic.strongest())
    line = lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(read(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Variants of the words of texts, in which some runs lose a letter by their crc32; those of a NULL doc_id lose none."""
    rows = variants.runs(docs, keep=("doc_id",)).withColumns({
        "h": F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run"))),
        "size": F.char_length("run"),
    })
    gone = F.expr("concat(substring(run, 1, CAST(h % size AS INT)), substring(run, CAST(h % size AS INT) + 2))")
    words = rows.select(F.when(F.col("h") % 31 == 0, gone).otherwise(F.col("run")).alias("run"))
    long_enough = words.filter(F.char_length("run") >= variants.LEAST_LENGTH)
    return variants.variants(spark, variants.counted(long_enough))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark, read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_ann": op5_ann,
    "op6_bpe": op6_bpe,
    "op7_decontaminate": op7_decontaminate,
    "op8_chat": op8_chat,
    "op9_suffixes": op9_suffixes,
    "op10_lm": op10_lm,
    "op11_packing": op11_packing,
    "op12_periodic": op12_periodic,
    "op13_variants": op13_variants,
}
# DuckDB has no crc32: its table from the polynomial, and the fold over the bytes of the hexadecimal text `x`.
CRC_TABLE = """tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i))"""
CRC = """xor(list_reduce(
      list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"""

# Runs by brute force: all pairs of equal stretches of eight words of a text, so every period is tried.
PERIODIC_SQL = rf"""WITH {CRC_TABLE},
split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, hex(encode(CAST(doc_id AS VARCHAR))) AS x FROM documents),
hashed AS (
  SELECT doc_id, w, len(w) AS n, {CRC} AS h
  FROM split, tab),
placed AS (
  SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS periodic, CASE WHEN n > 0 THEN (h // 10) % n END AS a,
    CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p
  FROM hashed),
words AS (
  SELECT doc_id, n, i, CASE WHEN periodic AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM placed)),
grams AS (
  SELECT doc_id, n, i, hash(word, lead(word, 1) OVER d, lead(word, 2) OVER d, lead(word, 3) OVER d, lead(word, 4) OVER d,
    lead(word, 5) OVER d, lead(word, 6) OVER d, lead(word, 7) OVER d) AS g
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
equal AS (
  SELECT a.doc_id, a.i, b.i - a.i AS p FROM (SELECT * FROM grams WHERE i + 8 <= n) a JOIN (SELECT * FROM grams WHERE i + 8 <= n) b
    ON a.doc_id = b.doc_id AND a.g = b.g AND b.i > a.i AND 3 * (b.i - a.i) <= a.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM equal),
stretches AS (
  SELECT doc_id, p AS period, min(i) AS start, max(i) - min(i) + 8 + p AS length FROM islands GROUP BY doc_id, p, island
  HAVING max(i) - min(i) + 8 + p >= greatest(24, 3 * p)),
runs AS (SELECT doc_id, start, length, min(period) AS period FROM stretches GROUP BY 1, 2, 3),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM runs GROUP BY 1),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY 1)
SELECT d.doc_id, coalesce(t.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(t.runs, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told t USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)"""

# Near words by their texts without one character.
VARIANTS_SQL = f"""WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, '{variants.UPPER}', '{variants.LOWER}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
said AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS x FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, {CRC} AS h
  FROM said, tab),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n FROM hashed GROUP BY 1),
kept AS (SELECT * FROM words WHERE length(word) >= 7 AND n >= 2),
cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM kept)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, k.word, k.n FROM cuts c JOIN kept k ON k.word = c.rest
  UNION SELECT k.word, c.word, c.n FROM cuts c JOIN kept k ON k.word = c.rest),
best AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS (
  SELECT k.word, k.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 10 * k.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 10 * k.n THEN b.other_n END AS form_n
  FROM kept k LEFT JOIN best b ON b.word = k.word),
walk AS (
  SELECT word, word AS here, 0 AS steps FROM forms
  UNION ALL SELECT w.word, f.form, w.steps + 1 FROM walk w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL)
SELECT f.*, w.root FROM forms f JOIN (SELECT word, arg_max(here, steps) AS root FROM walk GROUP BY 1) w ON w.word = f.word"""

# The others have no SQL that DuckDB can run; each is tested against a plain version in tests/llm.
ORACLES: dict[str, str] = {"op12_periodic": PERIODIC_SQL, "op13_variants": VARIANTS_SQL}
