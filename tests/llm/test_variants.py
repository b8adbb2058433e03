import random
import re
from collections import Counter
from zlib import crc32

from strata.llm import variants
from strata.llm.queries import spelling_variants


def near(a, b):
    """One character inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain(counts):
    """Every pair of words compared."""
    out, forms = {}, {}
    for word, n in counts.items():
        close = sorted((w for w in counts if near(word, w)), key=lambda w: (-counts[w], w))
        form = close[0] if close and counts[close[0]] >= 10 * n else None
        forms[word] = form
        out[word] = (n, len(close), form, counts[form] if form else None)
    for word in out:
        root = word
        while forms[root]:
            root = forms[root]
        out[word] = (*out[word], root)
    return out


def result(frame):
    rows = frame.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r[1:]) for r in rows}


def test_against_all_pairs(spark):
    rnd = random.Random(13)
    counts = {}
    for _ in range(60):
        base = "".join(rnd.choice("abé") for _ in range(rnd.randint(1, 8)))
        counts[base] = rnd.choice((2, 3, 40, 500, 6000))
        for _ in range(4):
            i, c = rnd.randrange(len(base) + 1), rnd.choice("abÿÀ")
            counts[rnd.choice((base[:i] + c + base[i:], base[:i] + base[i + 1:], base[:i] + c + base[i + 1:])) or "b"] = rnd.choice((2, 2, 20, 30))
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert result(variants.variants(spark, words)) == plain(counts)


def test_chains_ties_and_equal_characters(spark):
    counts = {"aaaaaaa": 2, "aaaaaa": 20, "aaaaab": 200, "aaaabb": 2000, "zebra": 3, "zebrb": 30, "zebrc": 30, "lonely": 5}
    got = result(variants.variants(spark, spark.createDataFrame(list(counts.items()), "word string, n bigint")))
    assert got == plain(counts)
    assert got["aaaaaaa"] == (2, 1, "aaaaaa", 20, "aaaabb") and got["zebra"][2] == "zebrb"
    assert got["lonely"] == (5, 0, None, None, "lonely")
    empty = spark.createDataFrame([], "word string, n bigint")
    assert variants.variants(spark, empty).count() == 0


def contract(rows):
    """The query's rows in plain Python."""
    counts = Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = 1 if i is None else crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return plain({w: n for w, n in counts.items() if n >= 2})


def test_query_is_the_contract(spark, docs):
    rnd = random.Random(6)
    stems = ["variants", "spelling", "ÀÉpreuve", "müßiggang", "Computer", "aaaaaaaa", "short", "sevenly"]
    rows = []
    for i in range(400):
        words = [rnd.choice(stems) for _ in range(rnd.randint(0, 30))]
        for k in range(len(words)):
            if rnd.random() < 0.05:
                at = rnd.randrange(len(words[k]))
                words[k] = words[k][:at] + rnd.choice("xyzÿ") + words[k][at + rnd.randint(0, 1):]
        rows.append((i, rnd.choice((" ", ", ", "1", "×")).join(words)))
    rows += [(900, None), (901, ""), (902, "12 34"), (None, "Variants spelling " * 4), (7, rows[7][1]), (903, "computer " * 50_000)]
    out = spelling_variants(spark, docs(rows))
    want = contract(rows)
    assert any(w[2] for w in want.values()) and result(out) == want
    assert sorted(out.dtypes) == sorted([
        ("word", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form", "string"), ("form_n", "bigint"), ("root", "string"),
    ])
    assert spelling_variants(spark, docs([])).count() == 0
