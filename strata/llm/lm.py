"""Language-model scores from sharded Elias-Fano n-gram tries.

The model is a bigram model with Dirichlet smoothing: p(v | u) = (c(uv) + m(u) P(v)) / (c(u) + m(u)). P(v) is
the absolutely discounted unigram probability; the discounted mass is the probability of an unknown word.
m(u) is `rare` for rare u and `common` * c(u) for words of at least the share 1 / COMMON_WORDS of all tokens, of
which there are at most COMMON_WORDS: that list has a fixed bound and travels with the tasks.

log p splits into a part that only needs v and the pair, and a part that only needs u. So each token is sent once
to the shard of its word, with its context; the shard counts, builds its trie in a memory-mapped file, looks up
every token and returns sums for each document. Documents of a map task are gathered into units, and equal pairs
of a unit travel once, with the list of documents. Words of more than a part of a shard's share, the end token too, are spread
over all shards by context; their counts come with the job. A text without words is one pair only, which every task
can score alone: its number is counted with the words and it is sent to no shard. Pairs count over all training documents; nothing is pruned.

Contexts are numbered by 32 bits; two contexts of one word may share a number with a chance of some 1e-10 a pair,
which can change `score` a little but never the counts of words. Ids must be integers.

NULL text is empty and has the end token only. Repeated rows are documents of their own. Without training documents
every token is unknown and has probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, settle, utf8, worker_cache
from strata.llm.eliasfano import Trie

COMMON_WORDS = 200_000
UNIT_TOKENS, UNIT_DOCS = 1_000_000, 60_000
SHARD_TOKENS = 2_000_000
LEAST_SHARDS = 12
END, START, EMPTY = np.uint64(1), np.uint64(2), np.uint64(3)  # hashes of words never take these
KEPT_WORDS = 300_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, 42) | 4
        self[word] = found
        return found


def hashes_of(text: bytes, known: WordHashes) -> np.ndarray:
    """Hashes of the words of a text and of its end."""
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def _words() -> WordHashes:
    known = worker_cache("lm-words", WordHashes)
    if len(known) > KEPT_WORDS:
        known.clear()
    return known


def word_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all training texts, words as hashes; EMPTY counts the texts without words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            words, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64),) * 2
            words, n = np.append(words, EMPTY), np.append(n, sum(len(h) == 1 for h in held))
            return pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"]
            )

        for batch in batches:
            known = _words()
            for text in batch.column("text").to_pylist():
                held.append(hashes_of(text, known))
                size += len(held[-1])
            if size >= UNIT_TOKENS:
                yield flush()
                held, size = [], 0
        yield flush()

    counted = map_batches(train.select(utf8(text_col).alias("text")), work, "word bigint, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Corpus:
    """Totals of the training tokens, and the words that are common or spread over the shards."""

    tokens: int
    words: int
    documents: int
    empty: int
    discount: float
    shards: int
    common: np.ndarray = field(repr=False)
    common_counts: np.ndarray = field(repr=False)
    spread: np.ndarray = field(repr=False)
    spread_counts: np.ndarray = field(repr=False)
    rare: float = 100.0
    share: float = 9.0

    def smoothing(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts * COMMON_WORDS >= max(self.tokens, 1), self.share * counts, self.rare)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, counts - self.discount, self.discount * self.words) / self.tokens

    def context_code(self, words: np.ndarray) -> np.ndarray:
        """0 the start of a text, then common words by place, then other words by hash."""
        at = np.minimum(np.searchsorted(self.common, words), max(0, len(self.common) - 1))
        is_common = self.common[at] == words if len(self.common) else np.zeros(len(words), bool)
        first = np.uint64(COMMON_WORDS + 1)
        other = first + (words >> np.uint64(8)) % (np.uint64(1 << 32) - first)
        code = np.where(is_common, at.astype(np.uint64) + np.uint64(1), other)
        return np.where(words == START, 0, code).astype(np.uint32)

    def context_smoothing(self, codes: np.ndarray) -> np.ndarray:
        """m(u) of contexts by code; codes of common words carry their count."""
        counts = np.concatenate(([self.documents], self.common_counts)).astype(np.float64)
        is_common = codes <= len(self.common_counts)
        m = np.full(len(codes), self.rare)
        m[is_common] = np.maximum(self.share * counts[codes[is_common]], 1e-9)
        if not self.documents:
            m[codes == 0] = self.rare
        return m


def corpus_of(train: DataFrame, text_col: str = "text") -> Corpus:
    counted = settle(word_counts(train, text_col), "lm-words")
    empty = counted.filter(F.col("word") == int(EMPTY)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = counted.filter(F.col("word") != int(EMPTY))
    end = F.col("word") == int(END)
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words"),
        F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
        F.coalesce(F.sum(F.when(end, F.col("n"))), F.lit(0)).alias("documents"),
    ).first()
    tokens = total["tokens"]
    shards = max(LEAST_SHARDS, -(-tokens // SHARD_TOKENS))

    def above(least: float, ends: bool) -> tuple[np.ndarray, np.ndarray]:
        """Words with at least that many tokens: at most tokens / least of them. The end is in or out at any number:
        it is never a context, and no shard sees all of it."""
        table = counts.filter(F.when(end, F.lit(ends)).otherwise(F.col("n") >= least)).toArrow()
        words = table.column("word").to_numpy().view(np.uint64)
        order = np.argsort(words)
        return words[order], table.column("n").to_numpy()[order]

    once, twice = total["once"], total["twice"]
    discount = min(0.95, max(0.1, once / (once + 2 * twice) if once else 0.5))
    common = above(max(1.0, tokens / COMMON_WORDS), ends=False)
    spread = above(max(1.0, tokens / (4 * shards)), ends=True)
    return Corpus(tokens, total["words"], total["documents"], empty, discount, shards, *common, *spread)


def _messages(rows: DataFrame, corpus: Corpus) -> DataFrame:
    """Rows (shard, unit, ...) of packed pairs, and one row of each unit's documents under a negative shard."""
    names = ["shard", "unit", "words", "pairs_of_word", "contexts", "events_of_pair", "docs", "train"]

    def pack(values: np.ndarray, kind: str) -> bytes:
        return values.astype(kind).tobytes()

    def unit_rows(unit: int, texts: list[np.ndarray], ids: list, train: list, held: list) -> pa.RecordBatch:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        tokens = np.concatenate(texts)
        words, rank = np.unique(np.append(tokens, START), return_inverse=True)
        before = np.empty(len(tokens), np.int64)
        before[1:] = rank[:-2]
        before[np.cumsum(lengths) - lengths] = rank[-1]
        rank = rank[:-1]
        code = corpus.context_code(words)[before]
        order = np.argsort((rank.astype(np.uint64) << np.uint64(32)) | code, kind="stable")
        order = order[np.repeat(lengths, lengths)[order] > 1]
        rank, code, doc = rank[order], code[order], np.repeat(np.arange(len(texts)), lengths)[order]
        home = (((words >> np.uint64(32)) * np.uint64(corpus.shards)) >> np.uint64(32)).astype(np.uint32)
        shard = home[rank]
        if len(corpus.spread):
            at = np.minimum(np.searchsorted(corpus.spread, words), len(corpus.spread) - 1)
            wide = (corpus.spread[at] == words)[rank]
            shard = np.where(wide, (code * np.uint32(0x9E3779B1) >> np.uint32(8)) % corpus.shards, shard).astype(np.uint32)
        order = np.argsort(shard, kind="stable")
        rank, code, doc, shard = rank[order], code[order], doc[order], shard[order]
        out: list[list] = [[] for _ in names]
        flags = np.packbits(np.array(train, bool)).tobytes()
        edges = np.searchsorted(shard, np.arange(corpus.shards + 1))
        for s in range(corpus.shards):
            a, b = edges[s], edges[s + 1]
            if a == b:
                continue
            r, c = rank[a:b], code[a:b]
            new_pair = np.concatenate(([True], (r[1:] != r[:-1]) | (c[1:] != c[:-1])))
            pair = np.flatnonzero(new_pair)
            new_word = np.flatnonzero(np.concatenate(([True], r[pair][1:] != r[pair][:-1])))
            row = (
                s, unit, words[r[pair[new_word]]].tobytes(), pack(np.diff(np.append(new_word, len(pair))), "<u4"),
                c[pair].tobytes(), pack(np.diff(np.append(pair, b - a)), "<u4"), pack(doc[a:b], "<u2"), flags,
            )
            for column, value in zip(out, row, strict=True):
                column.append(value)
        known = np.array([i is not None for i in ids], bool)
        meta = (
            -1 - unit % corpus.shards, unit, np.array([i or 0 for i in ids], "<i8").tobytes(), np.packbits(known).tobytes(),
            np.packbits(np.array(held, bool)).tobytes(), pack(lengths, "<u4"), b"", b"",
        )
        for column, value in zip(out, meta, strict=True):
            column.append(value)
        kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 24
        texts, ids, train, held, size = [], [], [], [], 0
        for batch in batches:
            known = _words()
            columns = (batch.column(c).to_pylist() for c in ("id", "text", "train", "held_out"))
            for i, text, learnt, out in zip(*columns, strict=True):
                texts.append(hashes_of(text, known)), ids.append(i), train.append(learnt), held.append(out)
                size += len(texts[-1])
                if size >= UNIT_TOKENS or len(texts) >= UNIT_DOCS:
                    yield unit_rows(unit, texts, ids, train, held)
                    unit, texts, ids, train, held, size = unit + 1, [], [], [], [], 0
        if texts:
            yield unit_rows(unit, texts, ids, train, held)

    schema = "shard int, unit bigint, " + ", ".join(f"{n} binary" for n in names[2:])
    return map_batches(rows, work, schema)


def _shard_sums(table: pa.Table, corpus: Corpus) -> pa.Table:
    """Sums of log probabilities by unit and document, from all pairs of one shard."""
    names = ["unit", "docs", "base", "score", "known"]
    if table.column("shard")[0].as_py() < 0:  # what a unit says of its documents passes through
        none = pa.array([None] * table.num_rows, pa.binary())
        packed = [
            len(i).to_bytes(4, "little") + len(k).to_bytes(4, "little") + i + k + h + n
            for i, k, h, n in zip(*(table.column(c).to_pylist() for c in ("words", "pairs_of_word", "contexts", "events_of_pair")), strict=True)
        ]
        return pa.table([table.column("unit"), none, none, none, pa.array(packed, pa.binary())], names=names)
    units = []
    for row in table.drop_columns(["shard"]).to_pylist():
        words = np.frombuffer(row["words"], "<u8")
        pairs_of_word = np.frombuffer(row["pairs_of_word"], "<u4")
        context = np.frombuffer(row["contexts"], "<u4")
        events = np.frombuffer(row["events_of_pair"], "<u4")
        docs = np.frombuffer(row["docs"], "<u2")
        train = np.unpackbits(np.frombuffer(row["train"], np.uint8))
        starts = np.concatenate(([0], np.cumsum(events, dtype=np.int64)[:-1]))
        learnt = np.add.reduceat(train[docs].astype(np.int64), starts)
        units.append((row["unit"], words, np.repeat(words, pairs_of_word), context, events, docs, learnt))
    word, context, learnt = (np.concatenate([u[k] for u in units]) for k in (2, 3, 6))
    seen = learnt > 0
    word, context, learnt = word[seen], context[seen], learnt[seen]
    order = np.lexsort((context, word))
    word, context, learnt = word[order], context[order], learnt[order]
    first = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (context[1:] != context[:-1])))[: len(word)])
    pair_count = np.add.reduceat(learnt, first) if len(first) else np.zeros(0, np.int64)
    word, context = word[first], context[first]
    words, place = np.unique(word, return_inverse=True)
    counts = np.bincount(place, pair_count, len(words)).astype(np.int64)
    if len(corpus.spread) and len(words):
        at = np.minimum(np.searchsorted(corpus.spread, words), len(corpus.spread) - 1)
        counts = np.where(corpus.spread[at] == words, corpus.spread_counts[at], counts)
    values = np.log10(pair_count + corpus.context_smoothing(context) * corpus.unigram(counts)[place])
    trie = Trie(words, counts, place, context, values)
    out: list[list] = [[] for _ in names]
    for unit, own, pair_word, pair_context, events, docs, _ in units:
        index = trie.word(own)
        count = trie.count(index)
        if len(corpus.spread):
            at = np.minimum(np.searchsorted(corpus.spread, own), len(corpus.spread) - 1)
            count = np.where(corpus.spread[at] == own, corpus.spread_counts[at], count)
        at = np.searchsorted(own, pair_word)
        unseen = np.log10(corpus.context_smoothing(pair_context) * corpus.unigram(count)[at])
        joint = trie.value(index[at], pair_context, unseen)
        left = np.where(own == END, 0.0, np.log10(count + corpus.smoothing(count)))
        score = np.repeat(joint - left[at], events)
        base = np.repeat(np.log10(count + 1.0)[at], events)
        known = np.repeat((count > 0)[at], events)
        size = int(docs.max()) + 1
        touched = np.flatnonzero(np.bincount(docs, minlength=size))
        row = (
            unit, touched.astype("<u2").tobytes(), np.bincount(docs, base, size)[touched].tobytes(),
            np.bincount(docs, score, size)[touched].tobytes(), np.bincount(docs, known, size)[touched].astype("<u4").tobytes(),
        )
        for column, value in zip(out, row, strict=True):
            column.append(value)
    kinds = [pa.int64()] + [pa.binary()] * 4
    return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)


def _documents(table: pa.Table, corpus: Corpus) -> pa.Table:
    """The rows of one unit: what the shards found, summed by document."""
    parts = table.to_pylist()
    meta = next(p["known"] for p in parts if p["docs"] is None)
    n_ids, n_known = int.from_bytes(meta[:4], "little"), int.from_bytes(meta[4:8], "little")
    count = n_ids // 8
    ids = np.frombuffer(meta, "<i8", count, 8)
    known_id = np.unpackbits(np.frombuffer(meta, np.uint8, n_known, 8 + n_ids), count=count).astype(bool)
    held = np.unpackbits(np.frombuffer(meta, np.uint8, n_known, 8 + n_ids + n_known), count=count).astype(bool)
    n_tokens = np.frombuffer(meta, "<u4", count, 8 + n_ids + 2 * n_known).astype(np.int64)
    base, score, known = np.zeros(count), np.zeros(count), np.zeros(count, np.int64)
    for part in sorted((p for p in parts if p["docs"] is not None), key=lambda p: p["docs"] + p["base"]):
        docs = np.frombuffer(part["docs"], "<u2")
        base[docs] += np.frombuffer(part["base"], "<f8")
        score[docs] += np.frombuffer(part["score"], "<f8")
        known[docs] += np.frombuffer(part["known"], "<u4")
    ends, bare = np.array([corpus.documents]), n_tokens == 1  # texts without words
    base[bare] = np.log10(ends + 1.0)
    score[bare] = np.log10(corpus.empty + corpus.context_smoothing(np.zeros(1, np.int64)) * corpus.unigram(ends))
    known[bare] = corpus.documents > 0
    base -= n_tokens * np.log10(corpus.tokens + corpus.words + 1)
    start = corpus.context_smoothing(np.zeros(1, np.int64))[0] + corpus.documents
    return pa.table({
        "id": pa.array(ids, mask=~known_id), "held_out": pa.array(held), "n_tokens": pa.array(n_tokens), "n_known": pa.array(known),
        "train_tokens": pa.array(np.full(count, corpus.tokens)), "base_score": pa.array(base), "score": pa.array(score - np.log10(start)),
    })


def score(df: DataFrame, train: Column, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows where `train` holds and score all rows."""
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    corpus = corpus_of(rows.filter("train"))
    sums = _messages(rows, corpus).groupBy("shard").applyInArrow(
        lambda table: _shard_sums(table, corpus), "unit bigint, docs binary, base binary, score binary, known binary"
    )
    return sums.groupBy("unit").applyInArrow(
        lambda table: _documents(table, corpus),
        "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
