"""Approximate nearest neighbours by multi-index hashing over learnt rotated binary codes.

Codes are the signs of a principal-component projection turned by several iterative-quantisation rotations, each
learnt from another start and worth up to 64 bits: the more bits, the better Hamming distance tells neighbours
from others, and the fewer vectors are ranked. A code is cut into substrings, each with an index of its own. By the pigeonhole principle a code
within Hamming radius r of a query has a substring within r // substrings of the query's, so probing those
buckets finds every code within the radius; the candidates are then ranked by their vectors in double
precision. The radius is what `share` of the true neighbours in the sample keep to. Where it holds
fewer than k candidates it is widened until there are k, or all.

Rotation and radius are fitted on a bounded sample, about `sample_rows` rows picked by a hash of their id;
every row is indexed. Rows are dealt into blocks by id, queries into blocks as well, and each pair of
blocks is one task that returns at most k rows for a query.

Vectors that are NULL, zero, hold NULL or non-finite components or have another length than most take no
part, nor do rows without an id. Rows repeated under one id count once (the closest). Ties go to the
smaller id. Columns not named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import settle

TURNS = 4  # rotations
BITS = 64 * TURNS
PART_BITS = 16
PARTS = BITS // PART_BITS
BLOCK = 16_384
QUERY_BLOCK = 2_048


@dataclass(frozen=True)
class Coder:
    mean: np.ndarray
    projections: np.ndarray  # turns x components x bits
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """A row of one word for each rotation for every vector."""
        centred = vectors - self.mean
        words = []
        for projection in self.projections:
            filled = np.zeros((len(vectors), 64), bool)
            filled[:, : projection.shape[1]] = centred @ projection > 0
            words.append(np.packbits(filled, axis=1, bitorder="little").view("<u8"))
        return np.concatenate(words, axis=1) if words else np.zeros((len(vectors), 0), "<u8")


def distance(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Differing bits of each code and one code."""
    return np.bitwise_count(codes ^ code).sum(axis=-1, dtype=np.int64)


def _usable(vectors: Column, size: int) -> Column:
    fine = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vectors) == size) & fine & F.exists(vectors, lambda x: x != 0), F.lit(False))


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).filter("id IS NOT NULL")
    sizes = rows.filter("size(vector) > 0").groupBy(F.size("vector").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(_usable(F.col("vector"), most["size"] if most else 0))


def fit(
    rows: DataFrame, total: int, sample_rows: int = 20_000, k: int = 10, share: float = 0.98, rounds: int = 30
) -> Coder:
    """Learn rotation and radius from a sample of (id, vector) rows."""
    part = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1_000_000))
    picked = rows.filter(part < int(min(1.0, sample_rows / max(total, 1)) * 1_000_000))
    found = picked.toArrow().sort_by("id")
    if not len(found):
        return Coder(np.zeros(1), np.zeros((TURNS, 1, 1)), BITS)
    sample = np.array(found.column("vector").to_pylist(), np.float64)
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(np.atleast_2d(centred.T @ centred))
    basis = axes[:, ::-1][:, :64]
    reduced = centred @ basis
    random = np.random.default_rng(29)
    projections = []
    for _ in range(TURNS):
        turn, _ = np.linalg.qr(random.normal(size=(reduced.shape[1],) * 2))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.sign(reduced @ turn).T @ reduced)
            turn = (left @ right).T
        projections.append(basis @ turn)
    coder = Coder(mean, np.array(projections), BITS)
    codes = coder.codes(sample)
    distances = []
    for i in random.permutation(len(sample))[:300]:
        gap = ((sample - sample[i]) ** 2).sum(axis=1)
        gap[i] = np.inf
        near = np.argsort(gap, kind="stable")[: min(k, len(sample) - 1)]
        distances.append(distance(codes[near], codes[i]))
    near = np.concatenate(distances)
    return Coder(mean, coder.projections, int(np.quantile(near, share, method="higher")) if len(near) else BITS)


class Index:
    """Substring indexes over the codes of a block."""

    def __init__(self, coder: Coder, ids: np.ndarray, vectors: np.ndarray):
        self.coder, self.ids, self.vectors = coder, ids, vectors
        self.codes = coder.codes(vectors)
        self.tables = []
        for part in range(PARTS):
            values = self._part(self.codes, part)
            order = np.argsort(values, kind="stable")
            buckets, counts = np.unique(values, return_counts=True)
            self.tables.append((order, buckets, counts))

    @staticmethod
    def _part(codes: np.ndarray, part: int) -> np.ndarray:
        word, shift = divmod(part * PART_BITS, 64)
        return ((codes[..., word] >> np.uint64(shift)) & np.uint64((1 << PART_BITS) - 1)).astype(np.uint16)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the Hamming radius, all of them."""
        probed = np.zeros(len(self.codes), bool)
        for part, (order, buckets, counts) in enumerate(self.tables):
            hit = np.bitwise_count(buckets ^ self._part(code, part)) <= radius // PARTS
            probed[order[np.repeat(hit, counts)]] = True
        rows = np.flatnonzero(probed)
        return rows[distance(self.codes[rows], code) <= radius]

    def nearest(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        code = self.coder.codes(query[None, :])[0]
        radius = self.coder.radius
        while True:
            rows = self.within(code, radius)
            rows = rows[self.ids[rows] != own]
            if len(np.unique(self.ids[rows])) >= k or radius >= BITS:
                break
            radius = min(BITS, radius + PARTS)
        gap = np.sqrt(((self.vectors[rows] - query) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[rows], gap))
        _, first = np.unique(self.ids[rows][best], return_index=True)
        best = best[np.sort(first)[:k]]
        return self.ids[rows][best], gap[best]


def search(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found for each row where `is_query`."""
    chosen = df.filter(is_query)
    rows = settle(usable(df, id_col, vector_col), "ann-rows")
    asked = rows.join(chosen.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    total = rows.count()
    coder = fit(rows, total, k=k)
    blocks = max(1, -(-total // block))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    all_of = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    dealt = rows.select(
        "id", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), all_of(query_blocks, "part")
    )
    asking = asked.dropDuplicates(["id"]).select(
        F.col("id").alias("own"), F.col("vector").alias("query"), all_of(blocks, "block"), F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("part")
    )

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        def values(table: pa.Table, name: str) -> np.ndarray:
            flat = pa.concat_arrays([c.flatten() for c in table.column(name).chunks])
            return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, -1)

        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            index = Index(coder, left.column("id").to_numpy(), values(left, "vector"))
            for own, query in zip(right.column("own").to_pylist(), values(right, "query"), strict=True):
                ids, gaps = index.nearest(own, query, k)
                found += zip([own] * len(ids), ids.tolist(), gaps.tolist(), strict=True)
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, types, strict=True)})

    key = ["block", "part"]
    found = dealt.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(
        work, "query_id bigint, vec_id bigint, score double"
    )
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.select("query_id", F.row_number().over(ranked).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
