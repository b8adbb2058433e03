"""Packing of token ids into windows: best fit among a bounded number of open windows.

Every partition packs its own texts as they come, with at most `OPEN` open windows. A text that fills whole windows
is laid into them; what is left goes into the open window with the least room that holds it. When none does, the
fullest window takes the head of the piece, which fills it, and is emitted; the rest of the piece is placed anew.
So only windows that are still open at the end of a partition have room left.

These leftovers are merged in rounds: `FAN` neighbouring partitions become one, their open windows are placed as
the texts were, and full windows are emitted. The last round lays what remains end to end. Its last
tokens, fewer than a window, are cut into powers of two, which need no padding.

A partition's rows are read in the order of the scan, so a task that is run again packs the same way. Each round is a
stored table, which a lost executor cannot take away.
"""

from __future__ import annotations

import json
import os
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import count, pairwise
from typing import Any

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.common import map_batches, settle, small_batches, utf8, worker_cache

SIZE = 1024
OPEN = 32  # windows a partition keeps open
FAN = 8  # partitions whose leftovers are merged together
# Fixed value: how byte-level tokenizer files split a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, part bigint"


@dataclass(frozen=True)
class Piece:
    """Consecutive ids of one text: its id, where they start, and the number of all its ids."""

    owner: Any
    start: int
    ids: np.ndarray
    total: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.owner, self.start, self.ids[:at], self.total),
            Piece(self.owner, self.start + at, self.ids[at:], self.total),
        )


def _length(load: list[Piece]) -> int:
    return sum(len(piece.ids) for piece in load)


def _cut(load: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The first `at` ids of a load of pieces, and the rest."""
    head, rest = [], list(load)
    while at and rest:
        piece = rest.pop(0)
        if len(piece.ids) > at:
            piece, tail = piece.cut(at)
            rest.insert(0, tail)
        head.append(piece)
        at -= len(piece.ids)
    return head, rest


class Packer:
    """Open windows of one partition. Full ones are handed to `emit`."""

    def __init__(self, size: int, limit: int, emit: Callable[[list[Piece]], None]):
        self.size, self.limit, self.emit = size, limit, emit
        self.room: list[tuple[int, int]] = []  # (room left, window), the fullest first
        self.windows: dict[int, list[Piece]] = {}
        self.numbers = count()

    def place(self, load: list[Piece]) -> None:
        length = _length(load)
        while length >= self.size:
            head, load = _cut(load, self.size)
            self.emit(head)
            length -= self.size
        while length:
            fit = bisect_left(self.room, (length, -1))
            if fit < len(self.room):
                room, window = self.room.pop(fit)
                self.windows[window] += load
                self._keep(window, room - length)
                return
            if len(self.room) < self.limit:
                window = next(self.numbers)
                self.windows[window] = list(load)
                self._keep(window, self.size - length)
                return
            room, window = self.room.pop(0)
            head, load = _cut(load, room)
            self.emit(self.windows.pop(window) + head)
            length -= room

    def _keep(self, window: int, room: int) -> None:
        if room:
            insort(self.room, (room, window))
        else:
            self.emit(self.windows.pop(window))

    def close(self) -> None:
        """Emit everything: whole windows, then powers of two."""
        load = [piece for _, window in self.room for piece in self.windows[window]]
        self.room, self.windows = [], {}
        length = _length(load)
        while length:
            part = min(self.size, 1 << (length.bit_length() - 1))
            head, load = _cut(load, part)
            self.emit(head)
            length -= part


class Rows:
    """Rows of pieces as Arrow batches: full windows, and at the end those still open, marked by `part`."""

    def __init__(self, owner: str, owner_type: pa.DataType, part: int, round_no: int):
        self.names = [owner, *(c.split()[0] for c in PIECE.split(", "))]
        self.types = [owner_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        self.part = part
        self.ids = count(round_no << 56 | part << 32)  # unlike in every partition and round
        self.rows: list[tuple] = []

    def add(self, window: list[Piece], is_open: bool = False) -> None:
        number, offset = next(self.ids), 0
        for piece in window:
            length = len(piece.ids)
            self.rows.append((
                piece.owner, piece.start, length, piece.ids.astype("<u4").tobytes(), piece.total, number, offset,
                self.part if is_open else None,
            ))
            offset += length

    def taken(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(self.names)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, self.types, strict=True)], names=self.names
        )
        self.rows = []
        return batch


def _byte_characters() -> dict[str, int]:
    """The character that a byte-level tokenizer file writes for each byte: itself if it can be seen, else one
    from 256 on, in order."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in seen]
    return {**{chr(b): b for b in seen}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def file_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary of a tokenizer file as ranks, or None if its merges are not in the order of their ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, special = spec["model"], {token["content"] for token in spec["added_tokens"]}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [model["vocab"][left + right] for left, right in pairs]
    plain = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]
    if not plain or any(a >= b for a, b in pairwise(merged)):
        return None
    byte = _byte_characters()
    return {bytes(map(byte.__getitem__, token)): i for token, i in model["vocab"].items() if token not in special}


class LibraryIds:
    """An encoder for `pack`: the ids that the tokenizers library gives by a file, without special tokens, then `end`.

    A byte-level file whose merges stand in the order of their ids says the same as ranks, for which there is a
    library several times as fast; other files are left to the tokenizers library itself.
    """

    def __init__(self, path: str, end: int):
        self.key = (path, end)

    def __call__(self) -> Callable[[list[str]], list[np.ndarray]]:
        path, end = self.key
        tail = np.array([end], "<u4")
        ranks = file_ranks(path)
        if ranks is None:
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            known = lambda text: np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        else:
            encoding = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
            known = lambda text: encoding.encode_to_numpy(text, disallowed_special=())
        return lambda texts: [np.concatenate([known(text), tail]).astype("<u4", copy=False) for text in texts]


def _pack_scan(
    docs: DataFrame, id_col: str, text_col: str, encoder: Callable, size: int, limit: int
) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("owner"), utf8(text_col).alias("text"))
    kind = rows.schema["owner"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encode, out = worker_cache(("packing", *encoder.key), encoder), None
        for batch in batches:
            if out is None:
                out = Rows("owner", batch.column("owner").type, TaskContext.get().partitionId(), 0)
                packer = Packer(size, limit, out.add)
            owners = batch.column("owner").to_pylist()
            texts = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            for owner, ids in zip(owners, encode(texts), strict=True):
                packer.place([Piece(owner, 0, ids, len(ids))])
            yield out.taken()
        if out is not None:
            for window in packer.windows.values():
                out.add(window, is_open=True)
            yield out.taken()

    return map_batches(rows, work, f"owner {kind}, {PIECE}")


def _merge(leftovers: DataFrame, round_no: int, last: bool, size: int, limit: int) -> DataFrame:
    """Open windows of `FAN` neighbouring partitions placed together. A group has at most FAN * limit windows."""
    schema = leftovers.schema
    kind = schema["owner"].dataType.simpleString()

    def work(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        out = Rows("owner", group.schema.field("owner").type, key[0].as_py(), round_no)
        packer, window, at = Packer(size, limit, out.add), [], None
        for row in group.select(["owner", "start", "ids", "doc_tokens", "sequence_id"]).to_pylist():
            if at is not None and row["sequence_id"] != at:
                packer.place(window)
                window = []
            at = row["sequence_id"]
            window.append(Piece(row["owner"], row["start"], np.frombuffer(row["ids"], "<u4"), row["doc_tokens"]))
        packer.place(window)
        if last:
            packer.close()
        for left in packer.windows.values():
            out.add(left, is_open=True)
        return pa.Table.from_batches([out.taken()])

    grouped = leftovers.withColumn("into", F.floor(F.col("part") / FAN).cast("bigint"))
    return small_batches(grouped).groupBy("into").applyInArrow(work, f"owner {kind}, {PIECE}")


def pack(
    docs: DataFrame,
    encoder: Callable,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    limit: int = OPEN,
) -> DataFrame:
    """Pieces of packed windows: id (as `id`), start, length, ids, doc_tokens, sequence_id, offset.

    `encoder` makes, in a worker, a function from texts to arrays of ids; its `key` tells it from others. Every id of a text lies in one piece; the pieces
    of a sequence lie end to end. A sequence has `size` ids, but for the last few, which have a power of two
    each. `size` must be one itself.

    NULL and empty texts have the ids the encoder gives the empty text; a text without ids has no piece. NULL and
    repeated ids are packed row by row like others. An empty table gives no rows, and other columns are ignored.
    """
    if size & (size - 1):
        raise ValueError("the size of a window must be a power of two")
    done, rows = [], settle(_pack_scan(docs, id_col, text_col, encoder, size, limit), "packed")
    top = rows.agg(F.max("part")).first()[0]
    for round_no in count(1):
        done.append(rows.filter(F.col("part").isNull()))
        if top is None:
            break
        top //= FAN
        # A round that leaves one partition is the last; nothing stays open after it.
        rows = settle(_merge(rows.filter(F.col("part").isNotNull()), round_no, top == 0, size, limit), "packed-rest")
        top = top or None
    whole = reduce(DataFrame.unionByName, done)
    return whole.withColumnRenamed("owner", "id").drop("part")
