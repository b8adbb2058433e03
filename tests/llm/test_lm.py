import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import lm
from strata.llm.eliasfano import EliasFano, Levels, Trie


@pytest.mark.parametrize("top, count", [(10, 0), (3, 5), (1 << 20, 1000), ((1 << 64) - 1, 3000), ((1 << 62), 1)])
def test_successor_search(top, count):
    rnd = random.Random(top)
    values = np.array(sorted({rnd.randint(0, top) for _ in range(count)}), np.uint64)
    levels = Levels()
    coded = EliasFano(levels, values)
    levels.seal()
    asked = np.array([*values.tolist(), *(rnd.randint(0, top) for _ in range(500))], np.uint64)
    place = {v: i for i, v in enumerate(values.tolist())}
    assert coded.find(asked).tolist() == [place.get(a, -1) for a in asked.tolist()]
    if count > 100:
        assert sum(levels.get(p).nbytes for p in (coded.low, coded.high)) < len(values) * (2 + math.log2(top / len(values))) / 8 * 1.1 + 64


def test_trie():
    trie = Trie(np.array([5, 9], np.uint64), np.array([3, 4]), np.array([0, 0, 1]), np.array([1, 7, 1]), np.array([-1.0, -2.0, -3.0]))
    index = trie.word(np.array([9, 5, 6, 5], np.uint64))
    assert index.tolist() == [1, 0, -1, 0] and trie.count(index).tolist() == [4, 3, 0, 3]
    found = trie.value(index, np.array([1, 7, 1, 2]), np.full(4, -9.0))
    assert np.allclose(found, [-3, -2, -9, -9], atol=1e-4)


def plain(texts: dict, train: set):
    tokens = {i: [w.decode() for w in (t or "").encode().lower().split()] + ["</>"] for i, t in texts.items()}
    uni, pairs = Counter(), Counter()
    for i in train:
        uni.update(tokens[i])
        pairs.update(zip(["<>", *tokens[i][:-1]], tokens[i], strict=True))
    n, v, docs = sum(uni.values()), len(uni), len(train)
    once, twice = (sum(c == k for c in uni.values()) for k in (1, 2))
    discount = min(0.95, max(0.1, once / (once + 2 * twice) if once else 0.5))
    p = lambda w: ((uni[w] - discount if uni[w] else discount * v) / n) if n else 1.0
    out = {}
    for i, own in tokens.items():
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in own)
        score = 0.0
        for u, w in zip(["<>", *own[:-1]], own, strict=True):
            seen = docs if u == "<>" else uni[u]
            common = seen and (u == "<>" or seen * lm.COMMON_WORDS >= max(n, 1))
            m = 9.0 * seen if common else 100.0
            score += math.log10((pairs[u, w] + m * p(w)) / (seen + m))
        out[i] = (len(own), sum(uni[w] > 0 for w in own), n, base, score)
    return out


@pytest.mark.parametrize("fold", [0, 1, 2])
def test_like_a_plain_model(spark, docs, fold, monkeypatch):
    monkeypatch.setattr(lm, "COMMON_WORDS", [200_000, 40, 40][fold])
    monkeypatch.setattr(lm, "UNIT_TOKENS", 300)
    rnd = random.Random(4)
    vocabulary = [f"w{i}é" for i in range(400)]
    texts = {i: " ".join(rnd.choices(vocabulary, [1 / (k + 1) for k in range(400)], k=rnd.randint(0, 80))) for i in range(120)}
    texts |= {200: None, 201: "", 202: "  ", 203: "HOT hot " * 700, 204: texts[3]}
    train = set() if fold == 2 else {i for i in texts if i % 3}
    frame = docs(list(texts.items()))
    learn = F.lit(False) if fold == 2 else F.col("doc_id") % 3 != 0
    got = {r.id: r for r in lm.score(frame, learn, F.col("doc_id") % 3 == 0).collect()}
    want = plain(texts, train)
    assert set(got) == set(want)
    for i, (tokens, known, n, base, score) in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, n, i % 3 == 0)
        assert abs(r.base_score - base) < 1e-6
        assert abs(r.score - score) < 1e-3 * tokens


def test_missing_ids_and_no_rows(spark, docs):
    out = lm.score(docs([(None, "a b"), (1, "a b"), (1, "a b")]), F.col("doc_id") > 0, F.lit(None).cast("boolean"))
    assert sorted((r.id or 0, r.n_tokens, r.train_tokens, r.held_out) for r in out.collect()) == [
        (0, 3, 6, False), (1, 3, 6, False), (1, 3, 6, False)]
    assert lm.score(docs([]), F.lit(True), F.lit(False)).count() == 0


def test_the_end_is_spread_over_the_shards(spark, docs):
    rows = docs([(i, f"w{i} v{i}") for i in range(1500)] + [(i, "") for i in range(1500, 3000)])
    rows = rows.select(F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("text"),
                       F.lit(True).alias("train"), F.lit(False).alias("held_out"))
    corpus = lm.corpus_of(rows)
    assert (corpus.documents, corpus.empty, corpus.tokens) == (3000, 1500, 6000)
    sent = lm._messages(rows, corpus).filter("shard >= 0").groupBy("shard").agg(F.sum(F.octet_length("docs") / 2).alias("n"))
    sizes = [r.n for r in sent.collect()]
    assert sum(sizes) == 4500 and max(sizes) < 2 * 4500 / corpus.shards


def test_trie_finds_contexts_of_their_own_word_only():
    rnd = np.random.default_rng(11)
    for count in (0, 1, 2, 400):
        words = np.unique(rnd.integers(0, 1 << 63, count).astype(np.uint64))
        held = {(w, int(c)): float(rnd.normal()) for w in range(len(words)) if w % 7 != 3
                for c in np.unique(rnd.choice([0, 1, 2, 5, 1 << 20, (1 << 32) - 1, int(rnd.integers(0, 1 << 32))], rnd.integers(1, 9)))}
        pairs = sorted(held)
        place, context = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.uint32)
        trie = Trie(words, np.arange(len(words)), place, context, np.array([held[p] for p in pairs]))
        asked = pairs + [(int(rnd.integers(-1, len(words) or 1)), int(c)) for c in rnd.choice([0, 1, 3, 1 << 20, (1 << 32) - 1], 300)]
        asked = [(w, c) for w, c in asked if w < len(words)]
        got = trie.value(np.array([w for w, _ in asked], np.int64), np.array([c for _, c in asked], np.uint32), np.full(len(asked), 99.0))
        for pair, value in zip(asked, got, strict=True):
            assert abs(value - held.get(pair, 99.0)) < 1e-3, pair
        assert trie.word(words).tolist() == list(range(len(words))) and trie.count(np.arange(len(words))).tolist() == list(range(len(words)))
    values = np.sort(rnd.integers(0, 1 << 40, 3000).astype(np.uint64))
    levels = Levels()
    coded = EliasFano(levels, values)
    levels.seal()
    assert coded.at(np.arange(3000)).tolist() == values.tolist()
