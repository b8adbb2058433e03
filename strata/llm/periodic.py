"""Runs of repeated words by online dyadic square catching.

The words of a text are appended to a stream. Every completed block of 2^k words becomes a catcher. With
each further word the suffix of 2^k words that ends there is compared with the one catcher between 2^k and
2^(k+1) words before it; equal names mean that the words in between may be the half of a square. A run
of period p, repeated three times or more, holds whole blocks of the largest power of two that is not above p,
so each of them catches it at distance p. Squares caught by neighbouring blocks at one distance belong to one
run and are merged; the ends are then found word by word, and the words compared, so names need not be exact.

A block that is itself periodic is met once in each of its periods, but only two distances can be
squares that are new: those between the starts, or between the ends, of the two runs of the short period.
The levels go up, so these runs are known by then, and the work stays within n log n names.

The stream is advanced a batch of texts and a level at a time; a mark between texts equals no word. Texts are
ordered by length, so that a level ends where the texts become too short for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, utf8

LEAST = 24  # words of a run, at least
TIMES = 3  # repetitions of its period, at least; two would need smaller blocks
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of doubled blocks from those of their halves. Equal blocks have equal names."""
    mixed = (left ^ (left >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ (mixed >> np.uint64(32))


def _common(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from a and from b on are equal, going right (step 1) or left (step -1); a < b."""
    most = len(words) - b if step > 0 else a + 1
    done, size = 0, 32
    while done < most:
        take = min(size, most - done)
        if step > 0:
            differ = words[a + done:a + done + take] != words[b + done:b + done + take]
        else:
            differ = (words[a - done - take + 1:a - done + 1] != words[b - done - take + 1:b - done + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, size = done + take, size * 2
    return done


class Known:
    """Runs found so far whose period is at most a bound, to look up the one that covers a block."""

    def __init__(self, runs: dict[tuple[int, int], int], longest: int):
        rows = sorted((start, end) for (start, end), period in runs.items() if period <= longest)
        self.start = np.array([r[0] for r in rows], np.int64)
        self.end = np.array([r[1] for r in rows], np.int64)
        # Runs of so short periods that both cover a block are one, so the farthest end decides.
        reach = np.maximum.accumulate(self.end) if rows else self.end
        self.best = np.maximum.accumulate(np.where(self.end == reach, np.arange(len(rows)), 0))

    def covering(self, at: np.ndarray, size: int) -> np.ndarray:
        """The run that holds the whole block at each place, or -1."""
        if not len(self.start):
            return np.full(len(at), -1)
        last = np.searchsorted(self.start, at, "right") - 1
        run = np.where(last < 0, 0, self.best[np.maximum(last, 0)])
        return np.where((last >= 0) & (self.end[run] >= at + size), run, -1)


def _catch(names: np.ndarray, size: int, known: Known) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and distances of the equal names of one level, in the order of distance and block."""
    blocks = names[::size]
    hits = np.flatnonzero(names[size:] == np.repeat(blocks, size)[:max(len(names) - size, 0)])
    block, period = hits // size, hits % size + size
    if len(known.start) and len(hits):
        here, there = known.covering(block * size, size), known.covering(block * size + period, size)
        both = (here >= 0) & (there >= 0)
        apart = (known.start[there] - known.start[here] == period) | (known.end[there] - known.end[here] == period)
        fresh = ~both | ((here != there) & apart)
        block, period = block[fresh], period[fresh]
    order = np.lexsort((block, period))
    return block[order], period[order]


def find_runs(words: np.ndarray, lengths: np.ndarray) -> dict[tuple[int, int], int]:
    """Smallest periods by (start, end) of all runs in a stream of texts.

    `words` holds the word ids of the texts, each followed by a mark that occurs nowhere else; `lengths` are
    their numbers of words, the longest first.
    """
    runs: dict[tuple[int, int], int] = {}
    ends = np.cumsum(lengths + 1)
    names = words.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    names ^= names >> np.uint64(31)
    size = 1
    while True:
        alive = int(np.searchsorted(-lengths, -max(LEAST, TIMES * size), "right"))
        if not alive:
            return runs
        names = names[:max(int(ends[alive - 1]) - size + 1, 0)]
        block, period = _catch(names, size, Known(runs, size // 3))
        first = np.flatnonzero(np.r_[True, (np.diff(period) != 0) | (np.diff(block) != 1)]) if len(block) else block
        count = np.diff(np.r_[first, len(block)])
        # The words of a run that equal those one period on hold so many whole blocks, at least.
        equal = np.maximum(LEAST - period[first], (TIMES - 1) * period[first])
        long_enough = count >= np.maximum((equal - size + 1) // size, 1)
        todo = [
            (int(b) * size, (int(b) + int(n)) * size, int(p))
            for b, n, p in zip(block[first][long_enough], count[long_enough], period[first][long_enough], strict=True)
        ]
        while todo:
            start, end, p = todo.pop()
            if not np.array_equal(words[start:end], words[start + p:end + p]):  # two blocks of one name
                todo += [(s, s + size, p) for s in range(start, end, size)] if end - start > size else []
                continue
            left = start - _common(words, start - 1, start - 1 + p, -1) if start else 0
            right = end + p + _common(words, end, end + p, 1)
            if right - left >= max(LEAST, TIMES * p):
                runs[left, right] = min(p, runs.get((left, right), p))
        names = _names(names[:-size], names[size:]) if len(names) > size else names[:0]
        size *= 2


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start and period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    ids: dict[bytes, int] = {}
    stream: list[int] = []
    for mark, i in enumerate(order, 1):
        stream += [ids.setdefault(word, len(ids)) for word in texts[i]]
        stream.append(-mark)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    begins = np.cumsum(lengths + 1) - lengths - 1
    for (start, end), period in find_runs(np.array(stream, np.int64), lengths).items():
        k = int(np.searchsorted(begins, start, "right")) - 1
        found[order[k]].append((start - int(begins[k]), end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that repeat what a run said one period before, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


def with_runs(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The `keep` columns, `n_words`, `runs` and `collapsed` of whole texts.

    Words are separated by ASCII white space and numbered from 0. A run is a maximal stretch of smallest period p
    with at least `TIMES` * p and at least `LEAST` words. `collapsed` keeps the first period of each run.

    NULL and empty texts have no words, no runs and an empty `collapsed`. Equal rows give equal results, an
    empty table gives none, and columns that are not asked for are ignored. A text is held whole by one task, with
    some 40 bytes a word beside it; nothing is shuffled.
    """
    kept = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], utf8(text_col).alias("text"))
    found_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.split() for text in batch.column("text").to_pylist()]
            found = runs_of_texts(texts)
            columns = [
                *(batch.column(k) for k in kept),
                pa.array([len(words) for words in texts], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], found_type),
                pa.array(map(collapse, texts, found), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "runs", "collapsed"])

    types = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept]
    out = map_batches(rows, work, ", ".join([*types, f"n_words bigint, runs {RUNS}, collapsed binary"]))
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)],
        "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"),
    )


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest length / period, compared exactly; the first of equal ones. NULL without runs."""
    one = RUNS.removeprefix("array<").removesuffix(">")
    return F.aggregate(
        runs, F.lit(None).cast(one),
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )
