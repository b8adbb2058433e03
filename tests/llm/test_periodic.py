import hashlib
import random
from fractions import Fraction
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import periodic
from strata.llm.queries import periodic_runs


def plain_runs(words):
    """Every period tried over the whole text; the smallest period of a stretch counts."""
    found, n = {}, len(words)
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def made(rnd):
    """Text with nested, neighbouring and broken repetitions."""
    words = []
    while len(words) < rnd.randint(0, 400):
        unit = [rnd.choice("abc") for _ in range(rnd.choice((1, 1, 2, 3, 5, 8, 13, 21, 40)))]
        if rnd.random() < 0.4:
            unit = unit * rnd.randint(1, 6) + [rnd.choice("abcd")]
        words += unit * rnd.randint(1, 7) + unit[:rnd.randint(0, len(unit))]
        if rnd.random() < 0.3 and words:
            words[rnd.randrange(len(words))] = "x"
    return [w.encode() for w in words]


def test_against_all_periods():
    rnd = random.Random(12)
    for _ in range(60):
        texts = [made(rnd) for _ in range(rnd.randint(1, 8))]
        assert periodic.runs_of_texts(texts) == [plain_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=90), max_size=4), st.integers(1, 12))
def test_two_letters(parts, times):
    texts = [[c.encode() for c in part * times] for part in parts]
    assert periodic.runs_of_texts(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("weak", [lambda a, b: a & b & 3, lambda a, b: (a + b) & 1])
def test_equal_names_of_other_blocks_only_cost_time(monkeypatch, weak):
    import numpy as np

    rnd = random.Random(4)
    texts = [made(rnd) for _ in range(12)]
    want = [plain_runs(t) for t in texts]
    monkeypatch.setattr(periodic, "_names", lambda a, b: weak(a, b).astype(np.uint64))
    got = periodic.runs_of_texts(texts)
    assert got == want  # merged segments of equal names are taken apart into blocks


def test_long_texts_take_linear_work():
    assert periodic.runs_of_texts([[b"a"] * 300_000]) == [[(0, 300_000, 1)]]
    unit = [str(i).encode() for i in range(50_000)]
    assert periodic.runs_of_texts([unit * 4]) == [[(0, 200_000, 50_000)]]
    nested = ([b"a"] * 40 + [b"b"]) * 3000
    runs = periodic.runs_of_texts([nested])[0]
    assert len(runs) == 3001 and max(r[2] for r in runs) == 41
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 30_000:
        a, b = b, b + a
    assert periodic.runs_of_texts([b[:1500]]) == [plain_runs(b[:1500])]
    assert len(periodic.runs_of_texts([b])[0]) > 100


def test_documents(spark, docs):
    loop = "the red fox ran " * 30
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, loop), (4, loop), (None, "go on " * 24 + "end"),
        (5, "x " * 23), (6, "start " + loop + "tail " * 50), (7, "é é " * 12), (8, "word " * 100_000),
    ]
    out = periodic.with_runs(docs(rows), keep=("doc_id", "id")).withColumn("best", periodic.strongest())
    assert out.columns[:2] == ["doc_id", "id"]
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        runs = plain_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        want.append((i or 0, len(words), runs, periodic.collapse(words, runs).decode()))
    assert got == sorted(want)
    best = {r.doc_id: r.best for r in out.collect()}
    assert best[5] is None and tuple(best[6]) == (121, 50, 1)
    assert periodic.with_runs(docs([])).count() == 0


def test_query_is_the_contract(spark, docs):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(("a", "b", "cc", "é")) for _ in range(rnd.randint(0, 120)))) for i in range(300)]
    rows += [(900, None), (901, " a  b\n" * 20), (None, "z " * 30)]
    want = {}
    for i, t in rows:
        words = (t or "").encode().split()
        n, h = len(words), 1 if i is None else crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
        want[i] = (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in dropped)).hexdigest(),
        )
    assert any(w[0] for w in want.values())
    out = periodic_runs(docs(rows))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == want
    assert [t for _, t in out.dtypes[1:6]] == ["bigint"] * 5
