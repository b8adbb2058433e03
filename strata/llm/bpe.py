"""Byte-level BPE with the public rank files: a segment tree over byte positions finds each merge.

The leaves of the tree are the byte positions of a piece. A leaf holds the rank of the pair that starts
there, with the position below it, so the root is the leftmost pair of the lowest rank. A merge kills
one position and changes the leaves of the merged token and of its live left neighbour: three point
updates of logarithmic cost. Short pieces are merged together, one tree per row of a matrix; long ones
alone. Ranks are read from a path on the executors and never trained.

NULL text is the empty text and has no ids; bytes that are not UTF-8 are read as U+FFFD. Equal rows
give equal results, and columns that are not asked for are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, utf8, worker_cache

NONE = np.int32(2**31 - 1)  # ranks times positions stay below it
LONGEST_ROW = 256  # bytes of a piece that is still merged as a row of a matrix
CACHED = 100_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Pair ranks as one sorted table, and the merge loop over segment trees."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=0) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pairs = pairs
        self.keys = np.fromiter(sorted(pairs), np.uint32 if self.size < 1 << 16 else np.uint64, len(pairs))
        self.values = np.fromiter((pairs[k] for k in self.keys.tolist()), np.int32, len(pairs))
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right = np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)
        self.byte_pairs = self.pair_ranks(left, right).reshape(256, 256)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where the pair never merges."""
        if not len(self.keys):
            return np.full(left.shape, NONE)
        kind = self.keys.dtype
        keys = left.astype(kind) * kind.type(self.size) + right.astype(kind)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], NONE)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        rows: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONGEST_ROW:
                out[i] = np.array(self.merge_long(piece), "<u4").tobytes()
            elif piece:
                rows.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, members in rows.items():
            step = max(1, (1 << 19) // width)
            for start in range(0, len(members), step):
                part = members[start : start + step]
                for i, ids in zip(part, self.merge_rows([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Merge pieces of at most `width` bytes, a power of two, each in its own tree."""
        count = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width)
        lengths = np.fromiter(map(len, pieces), np.int32, count)[:, None]
        spots = np.arange(width, dtype=np.int32)
        live = spots < lengths
        # Column `width` stands for "no neighbour".
        token = np.full((count, width + 1), -1, np.int32)
        token[:, :width] = np.where(live, self.byte_id[raw], -1)
        after = np.full((count, width + 1), width, np.int32)
        after[:, :width] = np.where(spots + 1 < lengths, spots + 1, width)
        before = np.full((count, width + 1), width, np.int32)
        before[:, 1:width] = spots[:-1]
        first = self.byte_pairs[raw[:, :-1], raw[:, 1:]]
        leaves = np.full((count, width), NONE)
        leaves[:, :-1] = np.where(live[:, 1:] & (first < NONE), np.minimum(first, 1 << 22) * width + spots[:-1], NONE)
        tree = [leaves]
        while tree[-1].shape[1] > 1:
            tree.append(np.minimum(tree[-1][:, 0::2], tree[-1][:, 1::2]))
        rows = np.arange(count)
        while True:
            best = tree[-1][rows, 0]
            some = best < NONE
            rows, best = rows[some], best[some]
            if not len(rows):
                break
            spot, rank = best % width, best // width
            gone = after[rows, spot]
            behind = after[rows, gone]
            token[rows, spot], after[rows, spot], before[rows, behind] = rank, behind, spot
            live[rows, gone] = False
            ahead = before[rows, spot]
            ahead = np.where(ahead == width, spot, ahead)
            tree[0][rows, gone] = NONE
            for changed in (spot, ahead):
                right = token[rows, after[rows, changed]]
                found = self.pair_ranks(token[rows, changed], right)
                open_pair = (right >= 0) & (found < NONE)
                found[~open_pair] = 0
                tree[0][rows, changed] = np.where(open_pair, found * width + changed, NONE)
            for level in range(len(tree) - 1):
                for changed in (gone, spot, ahead):
                    up = changed >> (level + 1)
                    tree[level + 1][rows, up] = np.minimum(
                        tree[level][rows, 2 * up], tree[level][rows, 2 * up + 1]
                    )
        ids = token[:, :width][live].astype("<u4").tobytes()
        ends = (np.cumsum(live.sum(axis=1)) * 4).tolist()
        return [ids[start:end] for start, end in zip([0, *ends], ends, strict=False)]

    def merge_long(self, piece: bytes) -> list[int]:
        """The same tree as one flat heap, for a single long piece."""
        count = len(piece)
        width = 1 << (count - 1).bit_length()
        none, size, pairs = 1 << 62, self.size, self.pairs
        token = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        tree = [none] * (2 * width)
        for i in range(count - 1):
            rank = pairs.get(token[i] * size + token[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(spot: int, value: int) -> None:
            node = width + spot
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low

        def pair(spot: int) -> int:
            right = after[spot]
            rank = pairs.get(token[spot] * size + token[right]) if right < count else None
            return none if rank is None else rank * width + spot

        while tree[1] < none:
            spot, rank = tree[1] % width, tree[1] // width
            gone = after[spot]
            token[spot], after[spot] = rank, after[gone]
            if after[gone] < count:
                before[after[gone]] = spot
            put(gone, none)
            put(spot, pair(spot))
            if before[spot] >= 0:
                put(before[spot], pair(before[spot]))
        ids, spot = [], 0
        while spot < count:
            ids.append(token[spot])
            spot = after[spot]
        return ids


def encode_texts(texts: list[str], merges: Merges, pattern, cache: dict[str, bytes]) -> list[bytes]:
    """Ids of whole texts; `cache` keeps pieces already merged; the older half goes when it is large."""
    split = [pattern.findall(text) for text in texts]
    if len(cache) > CACHED:
        for piece in list(islice(cache, len(cache) // 2)):
            del cache[piece]
    missing = list(set().union(*split) - cache.keys())
    cache.update(zip(missing, merges.encode([m.encode() for m in missing]), strict=True))
    out = [b"".join(map(cache.__getitem__, pieces)) for pieces in split]
    for piece in missing:
        if len(piece) > LONGEST_ROW:
            del cache[piece]
    return out


def encode(
    df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = (), back: bool = False
) -> DataFrame:
    """The `keep` columns and `ids`, the token ids of the whole text as packed little-endian 32-bit
    integers. Each match of `pattern` is merged separately and no special token is recognised. With `back` the ids
    are decoded to `decoded` in the same pass, which needs one worker a task where `decode` after it needs two."""
    kept = [f"k{i}" for i in range(len(keep))]
    made = ["ids", "decoded"] if back else ["ids"]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], utf8(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = worker_cache(("bpe", ranks_path), lambda: Merges(load_ranks(ranks_path)))
        cache: dict[str, bytes] = {}  # of one task: what a worker kept would stay in memory while other steps run
        split = regex.compile(pattern)
        token = {rank: text for text, rank in merges.ranks.items()} if back else {}
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            ids = encode_texts(texts, merges, split, cache)
            columns = [*(batch.column(k) for k in kept), pa.array(ids, pa.binary())]
            if back:
                columns.append(pa.array([_bytes_of(i, token) for i in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *made])

    types = [f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept]
    out = map_batches(rows, work, ", ".join([*types, *(f"{c} binary" for c in made)]))
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], *made)


def _bytes_of(ids: bytes, token: dict[int, bytes]) -> bytes:
    return b"".join(map(token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Adds `decoded`, the bytes that the packed ids stand for. NULL ids decode to nothing."""
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    source = names[df.columns.index(ids_col)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: text for text, rank in load_ranks(ranks_path).items()}
        for batch in batches:
            decoded = [_bytes_of(ids or b"", token) for ids in batch.column(source).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], names=[*names, "decoded"]
            )

    types = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    return map_batches(rows, work, ", ".join([*types, "decoded binary"])).toDF(*df.columns, "decoded")
