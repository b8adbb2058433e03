"""Removal of repeated byte strings by external induced sorting of sampled suffixes.

A full suffix array of a shard needs many times its size. Here only sampled suffixes are sorted, and the
others are induced from them, as induced sorting does with its leftmost-smaller suffixes:

1. Sampling. Every window of `GRAMS` consecutive 8-grams picks its smallest hash as the anchor of the string
   that starts with the window. The choice depends on the string alone, so equal strings of `LENGTH` bytes
   pick the same anchor at the same distance, and about one suffix in GRAMS / 2 is sampled.
2. Naming. Anchors are named by a hash of the bytes every string of the anchor has right of it. A name that
   occurs once is never repeated and is dropped; anchors whose whole neighbourhood is equal need no more.
3. Sorting. Spark sorts the tuples (name, bytes that follow) externally, on disk where they do not fit. The
   common prefix of neighbours is compared once.
4. Induction. From the order of the suffixes at distance d left of their anchors follows the order at d + 1: a
   stable partition by the byte in front. Common prefixes grow by one, or become the minimum over the range
   between new neighbours. A suffix is repeated if it shares LENGTH bytes with a neighbour.

A name with more than `crowd` different neighbourhoods is not induced in one task but by hashing each of
its strings, which Spark groups; the result is the same.

Passages of a number of words may be looked for as well, since they can be shorter than the length. Their anchors
are picked among runs of words in the same way and named likewise. Of each neighbourhood only one anchor is looked at closer:
its strings are hashed.

Anchors of repeated neighbourhoods are held in one row for each neighbourhood and part of the texts, and become merged
ranges part by part, so a passage that a third of all texts hold makes as many ranges as texts.

Results are judged on the input. Matches never cross documents. NULL text has no bytes. Texts shorter than
the length are kept whole. Repeated rows are occurrences of one another. Columns not named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, settle, utf8
from strata.session import freeing

LENGTH = 400
GRAMS = 150
COMMON = LENGTH - GRAMS + 1  # bytes from the anchor on that all strings of the anchor contain
AROUND = GRAMS - 1  # farthest start left of the anchor, and bytes after COMMON that may matter
SPOT_BITS = 28
PIECE = 1 << 24  # starts handled at once
CROWD = 100_000
PART_ROWS = 128  # texts whose ranges are merged together
HELD = 1 << 20  # ranges merged at once
PIECE_BYTES = 1 << 20  # of texts cut into words at once, at least one
ANCHORS = "row bigint, spot int, start int, end int, name bigint, around bigint"


def _smallest(values: np.ndarray) -> np.ndarray:
    """Minimum of every window of GRAMS values."""
    count = len(values) - GRAMS + 1
    blocks = -(-len(values) // GRAMS)
    padded = np.full(blocks * GRAMS, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, GRAMS)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[GRAMS - 1 : GRAMS - 1 + count])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every anchor: its place, and the nearest and farthest distance of strings that start left of it."""
    spots, nears, fars = [], [], []
    for begin in range(0, len(text) - LENGTH + 1, PIECE):
        piece = text[begin : begin + PIECE + LENGTH - 1]
        starts = len(piece) - LENGTH + 1
        count = starts + GRAMS - 1
        grams = np.ndarray((count,), "<u8", piece, 0, (1,))
        mixed = grams * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed &= np.uint64(~((1 << SPOT_BITS) - 1) & (1 << 64) - 1)
        mixed |= np.arange(count, dtype=np.uint64)
        spot = (_smallest(mixed) & np.uint64((1 << SPOT_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], spot[1:] != spot[:-1])))
        last = np.concatenate((first[1:], [starts])) - 1
        found = spot[first]
        spots.append(found + begin), nears.append(found - last), fars.append(found - first)
    if not spots:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(spots), np.concatenate(nears), np.concatenate(fars)


def sample(rows: DataFrame) -> DataFrame:
    """All anchors of `rows` (row, text): the place (`spot`), the range of bytes of all its strings, and two hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = xxhash.xxh3_64_intdigest
        for batch in batches:
            columns = _Columns("row", "spot", "start", "end", "name", "around")
            for owner, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                spots, nears, fars = anchors(text)
                name, around = [], []
                for p, n, f in zip(spots.tolist(), nears.tolist(), fars.tolist(), strict=True):
                    name.append(of(text[p : p + COMMON]))
                    around.append(of(text[p - f : p + LENGTH - n], n << 8 | f))
                hashes = [np.array(h, np.uint64) for h in (name, around)]
                columns.add(np.full(len(spots), owner, np.int64), spots, spots - fars, spots + LENGTH - nears, *hashes)
            yield columns.batch(spot=np.int32, start=np.int32, end=np.int32)

    return map_batches(rows, work, ANCHORS)


class _Columns:
    """Columns gathered in pieces."""

    def __init__(self, *names: str):
        self.pieces: dict[str, list[np.ndarray]] = {name: [] for name in names}

    def add(self, *arrays: np.ndarray) -> None:
        for pieces, array in zip(self.pieces.values(), arrays, strict=True):
            pieces.append(array)

    def batch(self, **kinds: type) -> pa.RecordBatch:
        """All pieces; hashes become signed, other columns keep their kind or get the one named."""
        whole = {}
        for name, pieces in self.pieces.items():
            joined = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
            joined = joined.view(np.int64) if joined.dtype == np.uint64 else joined
            whole[name] = pa.array(joined.astype(kinds.get(name, joined.dtype)))
        return pa.RecordBatch.from_pydict(whole)


def induce(
    group: np.ndarray, after: np.ndarray, before: np.ndarray, near: np.ndarray, far: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance at which each suffix is repeated (-1: never).

    Suffixes come sorted by `group` and the bytes `after` the common part; `before` holds the bytes in front
    of the anchor, the closest first. Both are filled up to AROUND columns.
    """
    count = len(group)
    least, most = np.full(count, -1), np.full(count, -1)
    if count < 2:
        return least, most
    usable = np.minimum(AROUND - near[1:], AROUND - near[:-1])
    differs = after[1:] != after[:-1]
    shared = np.where(differs.any(axis=1), differs.argmax(axis=1), AROUND)
    prefix = np.zeros(count, np.int64)  # with the suffix in front, after the common part
    prefix[1:] = np.where(group[1:] == group[:-1], np.minimum(shared, usable), -1)
    prefix[0] = -1  # -1 parts the classes
    order = np.arange(count)
    for distance in range(GRAMS):
        enough = prefix >= AROUND - distance
        hit = enough.copy()
        hit[:-1] |= enough[1:]
        at = order[hit]
        at = at[near[at] <= distance]
        least[at] = np.where(least[at] < 0, distance, least[at])
        most[at] = distance
        if distance == AROUND:
            break
        ahead, stays = before[order, distance], far[order] > distance
        same = prefix >= 0
        if not stays.all() or (same[1:] & (ahead[1:] != ahead[:-1])).any():
            part = np.cumsum(~same)
            keys = part * 256 + ahead
            old = np.flatnonzero(stays)
            if not len(old):
                break
            old = old[np.argsort(keys[old], kind="stable")]
            keys = keys[old]
            joined = np.concatenate(([False], keys[1:] == keys[:-1]))
            fresh = np.full(len(old), -1, np.int64)
            where = np.flatnonzero(joined)
            if len(where):
                bounds = np.stack((old[where - 1] + 1, old[where] + 1), axis=1).ravel()
                fresh[where] = np.minimum.reduceat(np.append(prefix, -1), bounds)[::2]
            company = joined.copy()
            company[:-1] |= joined[1:]
            order, prefix = order[old][company], fresh[company]
            if not len(order):
                break
    return least, most


def _induced(members: DataFrame) -> DataFrame:
    """(row, start, end) of what `members` (name, row, spot, near, far, alone, before, after) repeat."""
    rows = members.repartition("name").sortWithinPartitions("name", "after").select(
        "name", "row", "spot", "near", "far", "alone", "before", "after"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matrix(column: pa.Array, reverse: bool) -> np.ndarray:
            texts = column.to_pylist()
            flat = b"".join((t[::-1] if reverse else t).ljust(AROUND, b"\0") for t in texts)
            return np.frombuffer(flat, np.uint8).reshape(len(texts), AROUND)

        def solve(table: pa.Table) -> pa.RecordBatch:
            near, far, spot, row = (
                table.column(c).to_numpy().astype(np.int64) for c in ("near", "far", "spot", "row")
            )
            least, most = induce(
                table.column("name").to_numpy(), matrix(table.column("after"), False),
                matrix(table.column("before"), True), near, far,
            )
            keep = (least >= 0) & table.column("alone").to_numpy()
            return pa.RecordBatch.from_arrays(
                [pa.array(row[keep]), pa.array((spot - most)[keep]), pa.array((spot - least)[keep] + LENGTH)],
                names=["row", "start", "end"],
            )

        waiting: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            names = table.column("name").to_numpy()
            # Whole groups are solved; the last one may go on in the next batch.
            cut = int(np.searchsorted(names != names[-1], False)) if names[0] == names[-1] else int(np.flatnonzero(names != names[-1])[-1]) + 1
            if waiting and waiting[-1].column("name")[-1].as_py() != int(names[0]):
                yield solve(pa.concat_tables(waiting))
                waiting = []
            if cut:
                yield solve(pa.concat_tables([*waiting, table.slice(0, cut)]))
                waiting = []
            waiting.append(table.slice(cut))
        if waiting:
            yield solve(pa.concat_tables(waiting))

    return map_batches(rows, work, "row bigint, start bigint, end bigint")


def _hashed(members: DataFrame) -> DataFrame:
    """The same as `_induced`, by one hash for each string: for names with very many neighbourhoods."""
    distance = F.explode(F.sequence(F.col("near").cast("int"), F.col("far").cast("int"))).alias("distance")
    strings = members.select("*", distance).select(
        "name", "row", "spot", "alone", "distance",
        F.xxhash64(
            F.expr("substring(before, length(before) - distance + 1, distance)"), F.lit(0),
            F.expr(f"substring(after, 1, {AROUND} - distance)"), F.lit(1),
        ).alias("string"),
    )
    repeated = strings.groupBy("name", "distance", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = strings.filter("alone").join(repeated, ["name", "distance", "string"])
    return found.groupBy("row", "spot").agg(
        F.min("distance").alias("least"), F.max("distance").alias("most")
    ).select("row", (F.col("spot") - F.col("most")).alias("start"), (F.col("spot") - F.col("least") + LENGTH).alias("end"))


def merged_ranges(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the ranges of each row that touch or overlap."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order].astype(np.int64), end[order].astype(np.int64)
    shift = np.cumsum(np.concatenate(([False], row[1:] != row[:-1]))) << 32  # keeps rows apart; texts are shorter
    reach = np.maximum.accumulate(end + shift)
    first = np.flatnonzero(np.concatenate(([True], (start + shift)[1:] > reach[:-1])))
    last = np.concatenate((first[1:], [len(row)])) - 1
    return row[first], start[first], (reach - shift)[last]


def _whole(chunks: DataFrame) -> DataFrame:
    """(row, start, end), merged, of the anchors `held` in `chunks` (part, held), one part after the other."""
    rows = chunks.select("part", "held").repartition("part").sortWithinPartitions("part")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(held: list[pa.Array]) -> pa.RecordBatch:
            fields = dict(zip(("row", "spot", "start", "end"), pa.concat_arrays(held).flatten(), strict=True))
            found = merged_ranges(*(fields[c].to_numpy() for c in ("row", "start", "end")))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["row", "start", "end"])

        waiting: list[pa.Array] = []
        part, size = None, 0
        for batch in batches:
            parts, held = batch.column("part").to_numpy(), batch.column("held")
            edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low == high:
                    continue
                if waiting and (parts[low] != part or size > HELD):
                    yield solve(waiting)
                    waiting, size = [], 0
                waiting.append(held.slice(low, high - low).flatten())
                part, size = parts[low], size + len(waiting[-1])
        if waiting:
            yield solve(waiting)

    return map_batches(rows, work, "row bigint, start bigint, end bigint")


def _chunks(rows: DataFrame, sampled: DataFrame, label: str) -> DataFrame:
    """The anchors whose name occurs twice or more, stored by name, neighbourhood and part of the rows: `n`, the `first` and
    all that are `held` in one chunk. A hot pair makes few rows, however many texts it stands in."""
    found = settle(sampled, f"{label}-anchors")
    named = found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name")
    anchor = F.struct("row", "spot", "start", "end")
    part = F.pmod(F.xxhash64("row"), F.lit(max(1, rows.count() // PART_ROWS)))
    return settle(
        found.join(named, "name").groupBy("name", "around", part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min(anchor).alias("first"), F.collect_list(anchor).alias("held")
        ),
        f"{label}-chunks",
    )


def _sorted_out(rows: DataFrame, sampled: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The ranges of anchors whose whole neighbourhood is repeated, and what is left to find out: one anchor (name, row,
    spot, start, end) of each neighbourhood that shares its name with others, whether it is `alone`, and how many `kinds` share it."""
    chunks = freeing(rows.sparkSession, lambda: _chunks(rows, sampled, label))
    kinds = settle(
        chunks.groupBy("name", "around").agg(F.sum("n").alias("n"), F.min("first").alias("first")), f"{label}-kinds"
    )
    # Stored, so that a pair of a third of all rows can be split over tasks in the join, where it is some chunks.
    many = settle(kinds.filter("n > 1").select("name", "around"), f"{label}-many")
    several = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    asked = kinds.join(several, "name").select("name", "first.*", (F.col("n") == 1).alias("alone"), "kinds")
    return _whole(chunks.join(many, ["name", "around"])), asked


def repeats(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(row, start, end) ranges, possibly overlapping, that cover the repeated bytes of `rows` (row, text)."""
    whole, found = _sorted_out(rows, sample(rows), "suffix")
    asked = found.select(
        "name", "row", "spot", (F.col("spot") + LENGTH - F.col("end")).alias("near"), (F.col("spot") - F.col("start")).alias("far"),
        "alone", (F.col("kinds") > crowd).alias("crowded"),
    )
    listed = asked.groupBy("row").agg(F.collect_list(F.struct("name", "spot", "near", "far", "alone", "crowded")).alias("asked"))
    members = settle(
        rows.join(listed, "row").select("row", "text", F.inline("asked")).select(
            "name", "row", "spot", "near", "far", "alone", "crowded",
            F.expr("substring(text, spot - far + 1, far)").alias("before"),
            F.expr(f"substring(text, spot + {COMMON} + 1, {AROUND} - near)").alias("after"),
        ),
        "suffix-members",
    )
    induced = _induced(members.filter("NOT crowded"))
    hashed = _hashed(members.filter("crowded"))
    return settle(whole.unionByName(induced).unionByName(hashed), "suffix-ranges")


PUNCTUATION = bytes(range(33, 48)) + b":;<=>?@[\\]^_`{|}~"


KIND = np.full(256, 2, np.uint8)  # 0: white space, 1: punctuation
KIND[[*range(9, 14), *range(28, 33)]] = 0
KIND[list(PUNCTUATION)] = 1
LOADED = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first bytes of eight
LONG_WORD = 64
ODD, MIXER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIXER
    return values ^ (values >> np.uint64(29))


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word between ASCII white space, without the ASCII punctuation round it."""
    padded = text + bytes(8)
    kind = KIND[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(np.diff(kind > 0, prepend=False, append=False))
    starts, ends = edges[::2].copy(), edges[1::2].copy()
    core = np.flatnonzero(kind == 2)
    before = np.concatenate(([0], np.cumsum(kind == 2, dtype=np.int64)))
    low, high = before[starts], before[ends]
    bare = high > low
    starts[bare], ends[bare] = core[low[bare]], core[high[bare] - 1] + 1
    eights = np.ndarray((len(text) + 1,), "<u8", padded, 0, (1,))
    size = ends - starts
    hashes = size.astype(np.uint64) * ODD
    at = np.arange(len(size))
    for done in range(0, LONG_WORD, 8):
        part = eights[starts[at] + done] & LOADED[np.minimum(size[at] - done, 8)]
        hashes[at] = _mixed((hashes[at] ^ part) * ODD)
        at = at[size[at] > done + 8]
    for i in at.tolist():
        hashes[i] = xxhash.xxh64_intdigest(text[starts[i] : ends[i]])
    return starts, ends, hashes


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every window of `size` values."""
    reach = 1
    while 2 * reach <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Passages:
    """All passages of `words` words of some texts and their anchors. Words are numbered over all the texts.

    The anchor of a passage is the first of its runs of half as many words with the least hash. Of every anchor: its
    place `at`, the first and last passage that have it (`low`, `high`), its `text`, `name` and `around`."""

    def __init__(self, texts: list[bytes], words: int):
        self.words = words
        self.begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        self.starts, self.ends, hashes = words_of(b" ".join(texts))
        owner = np.searchsorted(self.begins, self.starts, "right") - 1
        count, size = len(hashes), words // 2
        powers, inverse = np.full((2, count + 1), ODD)
        inverse[:] = pow(int(ODD), -1, 1 << 64)
        powers[0] = inverse[0] = 1
        powers, self.inverse = np.cumprod(powers), np.cumprod(inverse)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1], dtype=np.uint64)))
        starts = np.arange(max(0, count - words + 1))
        inside = starts[owner[: len(starts)] == owner[words - 1 :]] if len(starts) else starts
        spot = inside
        if len(inside):
            runs = self.hashes(np.arange(count - size + 1), size)
            low_bits = np.uint64((1 << SPOT_BITS) - 1)
            marked = (runs & ~low_bits) | np.arange(len(runs), dtype=np.uint64)
            spot = (_least(marked, words - size + 1)[inside] & low_bits).astype(np.int64)
        first = np.flatnonzero(np.diff(spot, prepend=-1))
        last = np.concatenate((first[1:], [len(spot)]))[: len(first)] - 1
        self.at, self.low, self.high = spot[first], inside[first], inside[last]
        self.text = owner[self.at]
        self.spot = self.at - np.searchsorted(owner, self.text)  # word of the text
        self.name = self.hashes(self.at, size)
        place = ((self.at - self.low) << 32 | (self.at - self.high)).astype(np.uint64)
        self.around = _mixed((self.hashes(self.low, self.high - self.low + words) ^ _mixed(place)) * ODD)

    def hashes(self, first: np.ndarray, count: np.ndarray | int) -> np.ndarray:
        """A hash of runs of words: a polynomial in an odd number, so that it can be divided by its powers."""
        return _mixed((self.sums[first + count] - self.sums[first]) * self.inverse[first])

    def bytes_of(self, first: np.ndarray, last: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the passages from `first` to `last` start and end in their text."""
        return self.starts[first] - self.begins[text], self.ends[last + self.words - 1] - self.begins[text]


def _pieces(texts: list[bytes]) -> Iterator[slice]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > PIECE_BYTES:
            yield slice(first, i)
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def passages(rows: DataFrame, words: int) -> DataFrame:
    """(row, start, end) ranges, possibly overlapping, that cover the passages of `words` words in `rows` (row, text) that
    occur twice or more."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _Columns("row", "spot", "start", "end", "name", "around")
            row, texts = batch.column("row").to_numpy(), batch.column("text").to_pylist()
            for piece in _pieces(texts):
                all_ = Passages(texts[piece], words)
                columns.add(row[piece][all_.text], all_.spot, *all_.bytes_of(all_.low, all_.high, all_.text), all_.name, all_.around)
            yield columns.batch(spot=np.int32, start=np.int32, end=np.int32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _Columns("row", "start", "end", "string", "alone")
            row, texts = batch.column("row").to_numpy(), batch.column("text").to_pylist()
            asked = batch.column("asked").to_pylist()
            for piece in _pieces(texts):
                all_ = Passages(texts[piece], words)
                wanted = {i << 32 | a["spot"]: a["alone"] for i, spots in enumerate(asked[piece]) for a in spots}
                keys = (all_.text << 32 | all_.spot).tolist()
                hit = np.array([k for k, key in enumerate(keys) if key in wanted], np.int64)
                alone = np.array([wanted[keys[k]] for k in hit.tolist()], bool)
                size = all_.high[hit] - all_.low[hit] + 1
                nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                first, text = np.repeat(all_.low[hit], size) + nth, np.repeat(all_.text[hit], size)
                columns.add(row[piece][text], *all_.bytes_of(first, first, text), all_.hashes(first, words), np.repeat(alone, size))
            yield columns.batch(alone=bool)

    whole, asked = _sorted_out(rows, map_batches(rows, sampled, ANCHORS), "passage")
    listed = asked.groupBy("row").agg(F.collect_list(F.struct("spot", "alone")).alias("asked"))
    strings = settle(
        map_batches(
            rows.join(listed, "row").select("row", "text", "asked"), cut,
            "row bigint, start bigint, end bigint, string bigint, alone boolean",
        ),
        "passage-strings",
    )
    # Stored, so that a passage of very many kinds of neighbourhoods can be split over tasks in the join.
    twice = settle(strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("string"), "passage-twice")
    found = strings.filter("alone").join(twice, "string").select("row", "start", "end")
    return settle(whole.unionByName(found), "passage-ranges")


def _forward(text: bytes, at: int) -> int:
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at += 1
    return at


def _back(text: bytes, at: int) -> int:
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _joined(ranges: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of ranges that touch or overlap."""
    merged: list[list[int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def without_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), crowd: int = CROWD,
    whole_characters: bool = False, words: int | None = None, list_words: int | None = None,
) -> DataFrame:
    """id and `keep` columns, `kept` (bytes that are left), `spans` (removed [start, end) byte runs), `n_bytes` and
    `passages` of every row. With `whole_characters` the runs shrink to UTF-8 character boundaries.
    With `words`, repeated passages of so many words are removed as well. With `list_words`, the byte runs of
    repeated passages of so many words are listed in `passages`, whether or not they are removed."""
    kept = [f"k{i}" for i in range(len(keep))]
    base = df.select(
        F.xxhash64(id_col, text_col).alias("row"), F.col(id_col).alias("id"),
        *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], utf8(text_col).alias("text"),
    )
    spark = df.sparkSession
    texts = base.select("row", "text")
    ranges = freeing(spark, lambda: repeats(texts, crowd)).withColumn("listed", F.lit(False))
    for size, listed in ((words, False), (list_words, True)):
        if size:
            found = freeing(spark, lambda size=size: passages(texts, size))
            ranges = ranges.unionByName(found.withColumn("listed", F.lit(listed)))
    per_row = ranges.groupBy("row").agg(F.collect_set(F.struct("start", "end", "listed")).alias("ranges"))
    rows = base.join(per_row, "row", "left").select("id", *kept, "text", "ranges")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, runs, sizes, listed = [], [], [], []
            for text, ranges_ in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                merged = _joined((r["start"], r["end"]) for r in ranges_ or () if not r["listed"])
                listed.append([{"start": a, "end": b} for a, b in _joined((r["start"], r["end"]) for r in ranges_ or () if r["listed"])])
                if whole_characters:
                    merged = [run for run in ([_forward(text, a), _back(text, b)] for a, b in merged) if run[0] < run[1]]
                edges = [0, *(e for run in merged for e in run), len(text)]
                left.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                runs.append([{"start": a, "end": b} for a, b in merged])
                sizes.append(len(text))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(batch.column(k) for k in kept), pa.array(left, pa.binary()),
                 pa.array(runs, span), pa.array(sizes, pa.int64()), pa.array(listed, span)],
                names=["id", *kept, "kept", "spans", "n_bytes", "passages"],
            )

    types = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ["id", *kept]]
    runs_type = "array<struct<start: bigint, end: bigint>>"
    schema = ", ".join([*types, f"kept binary, spans {runs_type}, n_bytes bigint, passages {runs_type}"])
    return map_batches(rows, work, schema).toDF("id", *keep, "kept", "spans", "n_bytes", "passages")


def cleaned(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", words: int | None = None
) -> DataFrame:
    """`docs` with repeated strings taken out of the texts and, if there is one, the length column renewed.

    Only whole characters are removed, so what is left is valid text; NULL texts stay NULL."""
    others = [c for c in docs.columns if c != text_col]
    names = tuple(f"c{i}" for i in range(len(others)))
    given = docs.select(*[F.col(c).alias(n) for c, n in zip(others, names, strict=True)], F.col(text_col).alias("text"))
    marked = given.withColumn("blank", F.col("text").isNull())
    left = without_repeats(marked, names[others.index(id_col)], "text", (*names, "blank"), whole_characters=True, words=words)
    text = F.when(~F.col("blank"), F.decode("kept", "UTF-8"))
    columns = {c: F.col(n) for c, n in zip(others, names, strict=True)} | {text_col: text}
    if length_col in columns:
        columns[length_col] = F.when(text.isNotNull(), F.length(text).cast("long")).otherwise(F.col(names[others.index(length_col)]))
    return left.select(*[columns[c].alias(c) for c in docs.columns])
