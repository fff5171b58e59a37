"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree writes each vector as a long string of sign bits and keeps the strings in a sorted array. A query descends
in every tree to its longest matching prefix, then all trees ascend together, one bit at a time, so that ever larger
ranges of the arrays become candidates. The ascent ends when a vector as near as the query's present k-th best would
have been met with high probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import materialize

TREES = 64
BITS = 32            # length of the hash strings
CONFIDENCE = 0.95    # probability of having met a vector as near as the present k-th best
BLOCK_ROWS = 16_384  # vectors that one forest indexes
QUERY_ROWS = 256     # queries of one Arrow batch that are answered before the next is read
SEED = 11


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def directions(width: int, trees: int, bits: int, seed: int) -> np.ndarray:
    """Random directions of unit length, orthogonal in groups, which spreads the bits of a tree evenly."""
    rng = np.random.default_rng(seed)
    rows = []
    while sum(len(r) for r in rows) < trees * bits:
        rows.append(np.linalg.qr(rng.standard_normal((width, width)))[0].T)
    return np.concatenate(rows)[:trees * bits]


class Forest:
    """Sorted arrays of hash strings over one block of vectors; strings are unsigned integers, first bit highest."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int, bits: int, seed: int):
        self.ids, self.vectors, self.trees, self.bits = ids, vectors, trees, bits
        norms = np.linalg.norm(vectors, axis=1)
        self.longest = norms.max()
        # One more component makes all indexed vectors equally long; inner product order is then angle order.
        self.planes = directions(vectors.shape[1] + 1, trees, bits, seed)
        rest = np.sqrt(np.maximum(self.longest ** 2 - norms ** 2, 0.0))
        codes = self.hash(np.column_stack([vectors, rest]))
        self.order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def hash(self, rows: np.ndarray) -> np.ndarray:
        codes = np.zeros((self.trees, len(rows)), np.uint64)
        for tree in range(self.trees):
            signs = rows @ self.planes[tree * self.bits:(tree + 1) * self.bits].T > 0
            for bit in range(self.bits):
                codes[tree] = codes[tree] << np.uint64(1) | signs[:, bit].astype(np.uint64)
        return codes

    def ranges(self, tree: int, codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Where strings that share the first ``depth`` bits with each code stand in the tree's array."""
        drop = np.uint64(self.bits - depth)
        low = codes >> drop << drop
        high = low + (np.uint64(1) << drop)
        return np.searchsorted(self.sorted[tree], low), np.searchsorted(self.sorted[tree], high)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, confidence: float
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For every query the ids and scores of its k best candidates; ``own`` ids are no candidates."""
        n = len(self.ids)
        lengths = np.linalg.norm(queries, axis=1)
        codes = self.hash(np.column_stack([queries, np.zeros(len(queries))]))
        starts = np.zeros((self.bits + 1, self.trees, len(queries)), np.int32)
        ends = np.zeros_like(starts)
        for depth in range(self.bits + 1):
            for tree in range(self.trees):
                starts[depth, tree], ends[depth, tree] = self.ranges(tree, codes[tree], depth)
        for q in range(len(queries)):
            seen = np.zeros(n, bool)
            seen[self.ids == own[q]] = True
            found, scores = np.zeros(0, np.int64), np.zeros(0)
            slack = 1e-12 * self.longest * lengths[q]  # more than rounding can make
            # Depth of the longest prefix that any tree shares with the query: above it the ranges are empty.
            depth = int(np.flatnonzero((ends[:, :, q] > starts[:, :, q]).any(axis=1))[-1])
            while True:
                at = np.concatenate([self.order[t, starts[depth, t, q]:ends[depth, t, q]] for t in range(self.trees)])
                fresh = np.zeros(n, bool)
                fresh[at] = True
                fresh &= ~seen
                new = np.flatnonzero(fresh)
                seen |= fresh
                if len(new):
                    found = np.concatenate([found, new])
                    scores = np.concatenate([scores, self.vectors[new] @ queries[q]])
                if len(found) >= k:
                    kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                    near = scores >= kth - slack  # all that may tie with the k-th best
                    found, scores = found[near], scores[near]
                if depth == 0:
                    break
                if len(found) >= k:
                    cosine = np.clip(kth / (self.longest * lengths[q]), -1, 1)
                    same = 1 - np.arccos(cosine) / np.pi
                    if 1 - (1 - same ** depth) ** self.trees >= confidence:
                        break
                depth -= 1
            # Summed row by row, so that equal vectors get equal scores.
            exact = (self.vectors[found] * queries[q]).sum(axis=1)
            best = np.lexsort((self.ids[found], -exact))[:k]
            yield self.ids[found[best]], exact[best]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, bits: int = BITS, confidence: float = CONFIDENCE, block_rows: int = BLOCK_ROWS,
            seed: int = SEED) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score`` of the k rows with the largest inner product found.

    Rows are dealt evenly to blocks of about ``block_rows``; each block is indexed by a forest of its own, and every
    query, streamed in batches, searches every block. A block gives its k best, of which the k best overall stay.
    Scores are inner products of the original vectors in double precision; ties go to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no part, neither do rows with a null id or
    vectors whose width is not the commonest one. Rows that repeat an id count once, with the smallest vector. With
    fewer than k candidates all are returned. Equal vectors share all hash strings and are all found. An empty table
    gives an empty table. Other input columns are not looked at.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                          is_query.alias("asks"))
    clean = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    clean = materialize(clean.groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")), "vectors")
    widths = clean.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    width, n = (widths[0]["w"], widths[0]["count"]) if widths else (0, 0)
    blocks = max(1, -(-n // block_rows))
    clean = clean.where(F.size("v") == width)

    points = clean.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
                          F.lit(False).alias("asks"), "id", "v")
    queries = clean.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                                         "asks", "id", "v")
    # Points of a block come first, then its queries; both stream through the task in bounded batches.
    dealt = (points.unionByName(queries).repartitionByRange(blocks, "block")
             .sortWithinPartitions("block", "asks", "id"))
    result = StructType.fromDDL("query_id bigint, id bigint, score double")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = to_arrow_schema(result)
        block, forest, held_ids, held = None, None, [], []
        for batch in batches:
            for part in runs(batch):
                number, asks = part["block"][0].as_py(), part["asks"][0].as_py()
                ids = part["id"].to_numpy()
                rows = part["v"].flatten().to_numpy().reshape(len(ids), -1)
                if number != block:
                    block, forest, held_ids, held = number, None, [], []
                if not asks:
                    held_ids.append(ids)
                    held.append(rows)
                    continue
                if forest is None:
                    if not held:
                        continue
                    forest = Forest(np.concatenate(held_ids), np.concatenate(held), trees, bits, seed)
                    held_ids, held = [], []
                out = [(np.full(len(i), own), i, s) for own, (i, s)
                       in zip(ids, forest.search(rows, ids, k, confidence))]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=fields)

    found = dealt.mapInArrow(answer, result)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with one block and one kind of row, queries in bounded numbers."""
    keys = batch["block"].to_numpy() * 2 + batch["asks"].to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    for a, b in zip(edges, edges[1:]):
        step = QUERY_ROWS if keys[a:a + 1].any() and batch["asks"][a].as_py() else max(1, b - a)
        for start in range(a, b, step):
            yield batch.slice(start, min(step, b - start))
