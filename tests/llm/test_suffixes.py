import random

import numpy as np
import pytest

from strata.llm import suffixes


def brute(texts: list[bytes], length: int = 400) -> list[np.ndarray]:
    places: dict[bytes, list] = {}
    for k, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            places.setdefault(text[i : i + length], []).append((k, i))
    marks = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for k, i in found:
                marks[k][i : i + length] = True
    return marks


def sample_texts() -> list[str]:
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (70, 90, 100, 140, 400)]
    texts = [prose(rnd.randint(0, 300)) for _ in range(30)]
    for _ in range(40):
        parts = [prose(rnd.randint(0, 40)), rnd.choice(passages), prose(rnd.randint(0, 40)), rnd.choice(passages)]
        texts.append(" ".join(parts))
    for text in texts[-10:]:  # near copies
        cut = rnd.randrange(len(text))
        texts.append(text[:cut] + "#" + text[cut + 1 :])
    return [*texts, "ab" * 900, "a" * 399, "a" * 400, "a" * 401, "be " * 500, texts[3], ""]


@pytest.mark.parametrize("crowd", [suffixes.CROWD, 1])
def test_like_brute_force(spark, docs, crowd):
    texts = sample_texts()
    out = suffixes.without_repeats(docs(list(enumerate(texts))), crowd=crowd)
    got = {r.id: r for r in out.collect()}
    raw = [t.encode() for t in texts]
    for k, marks in enumerate(brute(raw)):
        want = bytes(np.frombuffer(raw[k], np.uint8)[~marks])
        assert got[k].kept == want, k
        assert sum(s.end - s.start for s in got[k].spans) == int(marks.sum()) and got[k].n_bytes == len(raw[k])


def test_repeated_rows_nulls_and_empty_tables(spark, docs):
    rnd = random.Random(1)
    text = " ".join(str(rnd.random()) for _ in range(40))
    out = suffixes.without_repeats(docs([(1, text), (1, text), (2, None), (None, "short"), (3, text + "é")]))
    assert sorted((r.id or 0, bytes(r.kept)) for r in out.collect()) == [
        (0, b"short"), (1, b""), (1, b""), (2, b""), (3, "é".encode())]
    assert suffixes.without_repeats(docs([])).count() == 0
    frame = docs([(1, "é" + text), (2, "è" + text), (3, None)]).withColumnRenamed("row", "n_chars")
    clean = suffixes.cleaned(frame)
    assert clean.columns == frame.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in clean.collect()} == {1: ("é", 1), 2: ("è", 1), 3: (None, 7)}


def test_groups_that_span_batches(spark, docs):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    rnd = random.Random(2)
    shared = " ".join(str(rnd.random()) for _ in range(60))
    texts = [f"{rnd.random()} {shared} {rnd.random()}" for _ in range(1300)]
    out = suffixes.without_repeats(docs(list(enumerate(texts))))
    assert max(len(r.kept) for r in out.select("kept").collect()) < 50


def test_passages_of_words(spark, docs):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghié") for _ in range(rnd.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, short = prose(51), prose(50)
    texts = [f"{prose(30)} x{k} ({shared}), y{k} {prose(rnd.randint(0, 90))}" for k in range(5)]
    texts += [f"{prose(9)} x{k} {short} y{k} {prose(60)}" for k in range(4)] + ["be " * 52, prose(200), ""]
    got = {r.doc_id: r.text for r in suffixes.cleaned(docs(list(enumerate(texts))), words=51).collect()}
    places = {}
    for k, text in enumerate(texts):
        words = [w.strip("(),") for w in text.split()]
        for i in range(len(words) - 50):
            places.setdefault(" ".join(words[i : i + 51]), []).append((k, i))
    hit = {k for found in places.values() if len(found) > 1 for k, _ in found}
    assert hit == {0, 1, 2, 3, 4, 9} and len(shared.encode()) < 400
    assert all(got[k] == t.replace(shared, "") for k, t in enumerate(texts) if k != 9) and got[9].strip() == ""


def test_query_lists_passages_beside_the_contract(spark, tmp_path):
    import hashlib

    from strata.llm.queries import op9_suffixes

    rnd = random.Random(16)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghi") for _ in range(rnd.randint(1, 4))) for _ in range(n))
    shared, long = prose(51), prose(150)
    rows = [(k, f"{prose(30)} x{k} {shared} y{k} {prose(20)}") for k in range(40)] + [(50, f"{long} q"), (51, f"r {long}"), (52, None), (53, prose(90))]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert len(shared.encode()) < 400 < len(long.encode())
    got = {r.doc_id: r for r in op9_suffixes(spark, str(tmp_path)).collect()}
    for k in range(40):
        row = got[k]
        assert (row.n_removed, row.n_passages, row.passage_bytes) == (0, 1, len(shared.encode()))
        assert row.kept_sha256 == hashlib.sha256(dict(rows)[k].encode()).hexdigest()
    # The blanks beside the long passage are part of a repeated string, not of a passage.
    assert all(got[k].n_spans == 1 and got[k].n_removed >= len(long.encode()) == got[k].passage_bytes for k in (50, 51))
    assert (got[53].n_passages, got[53].passage_bytes, got[52].n_passages) == (0, 0, 0)


def test_one_range_for_each_text_of_a_crowd(spark, docs):
    """A long passage in every text is one merged range of each, not a row for each of its anchors."""
    rnd = random.Random(8)
    shared = " ".join(str(rnd.random()) for _ in range(300))
    rows = docs([(k, f"{rnd.random()} {shared} {rnd.random()}") for k in range(200)])
    texts = rows.selectExpr("doc_id AS row", "cast(text AS binary) AS text")
    found = suffixes._sorted_out(texts, suffixes.sample(texts), "test")[0]
    assert found.count() == found.select("row").distinct().count() == 200
    assert "Generate" not in found._jdf.queryExecution().toString()


def test_words_like_a_regular_expression():
    import re

    rnd = random.Random(9)
    for length in (0, 1, 5, 400, 4000):
        text = bytes(rnd.choice(b"ab.,(\xc3\xa9 \t\x1c\x85-") for _ in range(length)) + b"x" * rnd.choice((0, 63, 64, 65, 200))
        starts, ends, hashes = suffixes.words_of(text)
        want = []
        for found in re.finditer(rb"[^\t-\r\x1c-\x20]+", text):
            word = found.group()
            bare = word.lstrip(suffixes.PUNCTUATION)
            start = found.start() + (len(word) - len(bare) if bare else 0)
            want.append((start, bare.rstrip(suffixes.PUNCTUATION) or word))
        got = [(s, text[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
        assert got == want and len(set(hashes.tolist())) == len({w for _, w in want})
