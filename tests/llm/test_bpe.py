import gc
import hashlib
import random
import sys
import time

import numpy as np
import public_tokenizers
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MERGES = bpe.Merges(bpe.load_ranks(RANKS))
SPLIT = regex.compile(public_tokenizers.PATTERN)
KNOWN = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=MERGES.ranks, special_tokens={})


def ids(text: str) -> list[int]:
    return np.frombuffer(bpe.encode_texts([text], MERGES, SPLIT, {})[0], "<u4").tolist()


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_like_the_library(text):
    assert ids(text) == KNOWN.encode_ordinary(text)


def test_long_pieces_and_runs():
    rnd = random.Random(3)
    for text in ("a" * 5000, "ab" * 3000, "é" * 700, "<|endoftext|>", " " * 999, "x" * 256, "x" * 257,
                 "".join(rnd.choice("aeinrst") for _ in range(20_000))):
        assert ids(text) == KNOWN.encode_ordinary(text)


def test_documents(spark, docs):
    rows = [(1, "Hello, world"), (2, None), (3, ""), (3, ""), (None, "x y"), (5, "word " * 40_000)]
    out = bpe.decode(bpe.encode(docs(rows), RANKS, public_tokenizers.PATTERN, keep=("doc_id", "id")), RANKS)
    got = sorted((r.doc_id or 0, hashlib.sha256(r.decoded).hexdigest(), len(r.ids)) for r in out.collect())
    want = sorted((i or 0, hashlib.sha256((t or "").encode()).hexdigest(), 4 * len(KNOWN.encode_ordinary(t or ""))) for i, t in rows)
    assert got == want and out.columns == ["doc_id", "id", "ids", "decoded"]
    once = bpe.encode(docs(rows), RANKS, public_tokenizers.PATTERN, keep=("doc_id", "id"), back=True)
    assert sorted(map(str, once.collect())) == sorted(map(str, out.collect())) and once.columns == out.columns
    assert bpe.encode(docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_few_pieces_are_held(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 100)
    cache, seen = {}, 0
    for i in range(40):
        text = " ".join(f"qz{i * 5 + j}qz" for j in range(20))
        assert np.frombuffer(bpe.encode_texts([text], MERGES, SPLIT, cache)[0], "<u4").tolist() == KNOWN.encode_ordinary(text)
        seen = max(seen, len(cache))
    assert seen < 250 and bpe.CACHED < len(MERGES.ranks) * 2


def test_workers_keep_no_pieces_after_their_task(spark, docs):
    bpe.encode(docs([(1, "one qzqzmarker more")]), RANKS, public_tokenizers.PATTERN).collect()

    def held(batches):
        for batch in batches:
            time.sleep(0.1)  # so that every worker gets a task
            module = sys.modules.get("_strata_llm_worker")
            reached, found = [vars(module)] if module else [], 0
            for _ in range(3):
                reached = gc.get_referents(*reached)
                found += sum(" qzqzmarker" in o for o in reached if type(o) is dict)
            yield batch.from_pydict({"found": [found]})

    assert not any(r.found for r in spark.range(0, 32, 1, 32).mapInArrow(held, "found bigint").collect())
