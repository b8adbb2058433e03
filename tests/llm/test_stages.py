"""Every stage of the pipeline, in its own settings, against plain Python on planted cases."""

import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import bpe, quality
from strata.llm.common import is_held_out, read

RND = random.Random(31)
ITEM = "Which of the seven rivers named above joins the old canal below the second bridge and why does it freeze first"


def prose(n, letters="abcdefghiklmnoprstu"):
    return " ".join("".join(RND.choice(letters) for _ in range(RND.randint(3, 8))) for _ in range(n))


def changed(text, share):
    """A copy with some words replaced, far enough apart that each costs five shingles."""
    words = text.split()
    for at in range(3, len(words), max(1, round(1 / share))):
        words[at] = f"new{RND.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture
def clashing(spark):
    """Documents with columns named like those used inside."""

    def make(rows):
        frame = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows],
                                      "doc_id bigint, text string, lang string, source string, n_chars bigint")
        extra = {name: F.lit(k) for k, name in enumerate(("score", "_row", "row", "label", "weight", "key", "id", "c0", "part"))}
        return frame.withColumns(extra).repartition(3)

    return make


@pytest.fixture
def tables_of(spark, tmp_path):
    def make(**tables):
        for name, frame in tables.items():
            frame.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make


def by_id(frame):
    rows = frame.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r for r in rows}


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_duplicates(spark, clashing):
    bases = [prose(n) for n in (12, 30, 60, 60, 120, 200)]
    rows = [(100 * k + n, text) for k, base in enumerate(bases) for n, text in enumerate(
        [base, base, base.upper(), changed(base, 0.012), changed(base, 0.02), changed(base, 0.04), changed(base, 0.09), base + " tail"])]
    rows += [(5000 + n, changed(bases[5], 0.015)) for n in range(60)]
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "one"), (9004, "ONE "), (9005, prose(80)), (9006, prose(80))]
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    borderline = 0
    for i in sets:
        for j in sets:
            if i < j:
                shared, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
                borderline += 0.6 < shared / union < 0.8
                if shared * 5 >= union * 4:
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    assert borderline > 20
    docs = clashing(rows)
    out = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert out.columns == docs.columns
    assert set(by_id(out)) == {root(i) for i in sets}
    assert corpus_pipeline.one_of_each_group(spark, clashing([]), "").count() == 0


def test_repeated_strings(spark, clashing):
    passage, short, long = prose(51), prose(40), prose(90)
    rows = [(k, f"{prose(20)} start{k} {passage} end{k} {prose(15)}") for k in range(30)]
    rows += [(100 + k, f"{prose(10)} begin{k} {long} stop{k}") for k in range(2)]
    rows += [(200 + k, f"{prose(10)} lead{k} {short} trail{k} {prose(70)}") for k in range(3)] + [(300, None), (301, ""), (302, prose(400))]
    got = by_id(corpus_pipeline.drop_repeats(spark, clashing(rows), ""))
    bytes_at, words_at, gone = {}, {}, {i: [False] * len(t or "") for i, t in rows}
    for i, text in rows:
        for at in range(len(text or "") - 399):
            bytes_at.setdefault(text[at:at + 400], []).append((i, at, at + 400))
        words = [(m.start(), m.end()) for m in re.finditer(r"\S+", text or "")]
        for first, last in zip(words, words[50:]):
            words_at.setdefault(text[first[0]:last[1]], []).append((i, first[0], last[1]))
    for found in (*bytes_at.values(), *words_at.values()):
        for i, start, end in found if len(found) > 1 else ():
            gone[i][start:end] = [True] * (end - start)
    assert sum(any(g) for g in gone.values()) == 32  # the passages of 51 and 90 words, not the one of 40
    for i, text in rows:
        want = None if text is None else "".join(c for c, g in zip(text, gone[i]) if not g)
        assert (got[i].text, got[i].n_chars) == (want, len(want or "")), i


def test_benchmark_leaks(spark, clashing, tables_of):
    bench = [(1, ITEM), (2, prose(25)), (3, None), (4, "too short")]
    sf = tables_of(benchmark=spark.createDataFrame(bench, "item_id bigint, text string"))
    half = " ".join(bench[1][1].split()[:8])
    rows = [(1, f"{prose(30)} {ITEM} {prose(9)}"), (2, bench[1][1]), (3, f"{half} {prose(40)}"), (4, None), (5, ""), (6, prose(200)),
            (7, "too short"), (8, f"{prose(300)} {bench[1][1]}")]
    out = corpus_pipeline.drop_leaks(spark, clashing(rows), sf)
    windows = lambda t: {tuple(t.lower().split()[i:i + 5]) for i in range(len(t.split()) - 4)}
    leaks = {i for i, t in rows for _, b in bench if t and b and windows(b) and 2 * len(windows(b) & windows(t)) >= len(windows(b))}
    assert leaks == {1, 2, 8} and set(by_id(out)) == {i for i, _ in rows} - leaks


def test_quality_keeps_what_scores_enough(spark, clashing, tables_of):
    good = [(i, ". ".join(prose(9).capitalize() for _ in range(6))) for i in range(120)]
    bad = [(1000 + i, " ".join(RND.choice(("BUY!!!", "$$$", "click", "####", "win")) for _ in range(40))) for i in range(60)]
    rows = [*good, *bad, (5000, None), (5001, ""), (5002, "A line of plain words. " * 20_000)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in rows[:180]], "doc_id bigint, quality int")
    sf, docs = tables_of(labels=labels), clashing(rows)
    out = corpus_pipeline.keep_good(spark, docs, sf)
    assert out.columns == docs.columns
    learnt = labels.filter(~is_held_out("doc_id", 5, 0)).select("doc_id", F.col("quality").alias("label"))
    model = quality.fit_documents(docs, learnt)
    facts = quality.statistics(docs, keep=("doc_id",)).select("doc_id", model.score().alias("s")).collect()
    assert set(by_id(out)) == {r.doc_id for r in facts if r.s >= corpus_pipeline.QUALITY_LEAST}
    kept = set(by_id(out))
    assert {i for i, _ in good} <= kept and not kept & {i for i, _ in bad}


def test_tokens(spark, clashing):
    known = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(corpus_pipeline.RANKS), special_tokens={})
    rows = [(1, "Some text, naïve 42."), (2, None), (3, ""), (4, "word " * 9000)]
    for i, row in by_id(corpus_pipeline.tokenise(spark, clashing(rows), "")).items():
        want = known.encode_ordinary(dict(rows)[i] or "")
        assert row.n_tokens == len(want) and row.round_trip and bytes(row.ids) == b"".join(t.to_bytes(4, "little") for t in want)


def test_run_is_its_stages_in_turn(spark):
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
    assert set(by_id(corpus_pipeline.run(spark, sf))) == {r.doc_id for r in docs.select("doc_id").collect()}
