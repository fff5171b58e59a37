"""Ranked lexical search with geometric blocks of posting lists.

Documents are counted once against the terms of a block of items. Each task then takes its documents in portions: the
posting list of a term is clustered by the similarity of its documents, every cluster (block) keeps the largest impact
per coordinate among its documents, and an item's terms are walked from the strongest on. The item's product with a
summary bounds the score of every document of the block, so a block is skipped only if this bound is below the item's
tenth best score so far; likewise all remaining terms are, once their largest impacts together are. The documents of
other blocks are scored exactly. Only the best of each task meet in the end.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize
from .arrow import as_bytes, extend, map_rows

TERM = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")  # letters and digits of ASCII, and all else beyond ASCII
BLOCK_TERMS = 200_000  # terms of a block of items, the part that tasks know at a time
POSTINGS = 400_000     # postings of a portion of documents
LIST = 32              # documents of a block, on average
SKETCH = 32            # dimensions in which documents are compared for clustering
CACHED = 4_000_000     # coordinates of summaries kept at a time
SCALE = 1_000_000_000


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())


@dataclass
class Items:
    """A block of items: their terms by number, and what the corpus says about the terms."""

    vocabulary: dict[bytes, int]
    terms: dict[int, np.ndarray]  # item number -> distinct term numbers
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_docs: int = 0
    n_terms: int = 0

    def weigh(self, counted: DataFrame) -> None:
        """Take counts over all documents: how many hold a term, how many terms there are, how many hold each term."""
        self.n_docs, self.n_terms = (v or 0 for v in counted.agg(F.count("*"), F.sum("n")).first())
        found = (counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))).toArrow()
        df = np.zeros(len(self.vocabulary), np.int64)
        df[found["t"].to_numpy()] = found["df"].to_numpy()
        self.weights = np.array([math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * int(d) + 1))) for d in df],
                                np.int64)

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What each posting adds to a score; ``n`` is the length of its document."""
        m = 100 - 90 + (90 * n * self.n_docs) // max(self.n_terms, 1)
        return self.weights[term] * ((SCALE * tf) // (1000 * tf + 8 * m))


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_terms: int) -> tuple[DataFrame, int]:
    """Rows ``no`` (a number per row), ``item``, ``terms`` and ``block``, and the number of blocks."""

    def cut(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            yield row["no"], row["item"], sorted(set(terms_of(row["text"])))

    numbered = materialize(items.select(F.monotonically_increasing_id().alias("no"), F.col(item_col).alias("item"),
                                        as_bytes(text_col).alias("text")), "items")
    cut_items = materialize(map_rows(numbered, extend(numbered, ["no", "item"], "terms array<binary>"), cut), "items")
    total = cut_items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_terms))
    return cut_items.withColumn("block", F.pmod(F.xxhash64("no"), F.lit(blocks)).cast("int")), blocks


def count_terms(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n`` (terms with repeats), and ``terms`` with ``tfs`` for those that an item asks for."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def count(rows: Iterator[dict]) -> Iterator[tuple]:
        number = shared.value.get
        for row in rows:
            found = terms_of(row["text"])
            if found:
                counts = Counter(map(number, found))
                counts.pop(None, None)
                yield row["id"], len(found), list(counts), list(counts.values())

    rows = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    return materialize(map_rows(rows, extend(rows, ["id"], "n bigint, terms array<int>, tfs array<int>"), count), "terms")


class Portion:
    """Documents of a task with their impacts, and the blocks of their posting lists, built when asked for."""

    def __init__(self, items: Items, directions: np.ndarray, lengths: list[int], sizes: list[int], terms: list[int],
                 tfs: list[int]):
        n_docs, width = len(sizes), len(items.weights)
        sizes = np.array(sizes)
        doc, term = np.repeat(np.arange(n_docs), sizes), np.array(terms, np.int64)
        impact = items.impacts(term, np.array(tfs, np.int64), np.repeat(np.array(lengths, np.int64), sizes))
        known = impact > 0
        self.doc, self.term, self.impact, self.width = doc[known], term[known], impact[known], width
        self.edges = np.append(0, np.cumsum(np.bincount(self.doc, minlength=n_docs)))
        by_term = np.argsort(self.term, kind="stable")
        self.listed = self.doc[by_term]
        self.list_edges = np.append(0, np.cumsum(np.bincount(self.term, minlength=width)))
        self.strongest = np.zeros(width, np.int64)
        np.maximum.at(self.strongest, self.term, self.impact)
        sketch = np.zeros((n_docs, SKETCH), np.float32)
        for d in range(SKETCH):
            sketch[:, d] = np.bincount(self.doc, self.impact * directions[self.term, d], n_docs)
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        self.blocks: dict[int, tuple] = {}
        self.cached = 0

    def gather(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all postings of ``docs``, and for each the place of its document among them."""
        sizes = self.edges[docs + 1] - self.edges[docs]
        row = np.repeat(np.arange(len(docs)), sizes)
        first = np.cumsum(sizes) - sizes
        return np.arange(len(row)) - first[row] + self.edges[docs][row], row

    def blocks_of(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents of a posting list by block, edges of the blocks, and their summaries (block, coordinate, maximum)."""
        if term in self.blocks:
            return self.blocks[term]
        docs = self.listed[self.list_edges[term]:self.list_edges[term + 1]]
        count = max(1, len(docs) // LIST)
        block = np.zeros(len(docs), np.int64)
        if count > 1:
            leaders = self.sketch[docs[np.linspace(0, len(docs) - 1, count).astype(np.int64)]]
            step = max(1, (1 << 22) // count)
            for s in range(0, len(docs), step):
                block[s:s + step] = (self.sketch[docs[s:s + step]] @ leaders.T).argmax(1)
        order = np.argsort(block, kind="stable")
        docs, block = docs[order], block[order]
        edges = np.append(0, np.cumsum(np.bincount(block, minlength=count)))
        at, row = self.gather(docs)
        keys = block[row] * self.width + self.term[at]
        ranked = np.argsort(keys, kind="stable")
        keys = keys[ranked]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        found = (docs, edges, keys[starts] // self.width, keys[starts] % self.width,
                 np.maximum.reduceat(self.impact[at][ranked], starts))
        if self.cached + len(starts) > CACHED:
            self.blocks.clear()
            self.cached = 0
        self.cached += len(starts)
        self.blocks[term] = found
        return found

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        at, row = self.gather(docs)
        wanted = asked[self.term[at]]
        return np.bincount(row[wanted], self.impact[at[wanted]], len(docs)).astype(np.int64)  # sums stay below 2^53

    def search(self, terms: np.ndarray, lowest: int, keep) -> None:
        """Offer ``keep`` (documents, scores) all that may score ``lowest`` or more; it returns the new lowest score."""
        asked = np.zeros(self.width, bool)
        asked[terms] = True
        terms = terms[np.argsort(-self.strongest[terms], kind="stable")]
        remaining = np.cumsum(self.strongest[terms][::-1])[::-1]
        seen = np.zeros(len(self.edges) - 1, bool)
        for term, best in zip(terms.tolist(), remaining.tolist()):
            if best < max(lowest, 1):
                return  # whatever holds only the terms from here on scores no more than this
            docs, edges, block, coordinate, most = self.blocks_of(term)
            inside = asked[coordinate]
            bounds = np.bincount(block[inside], most[inside], len(edges) - 1)
            order = np.argsort(-bounds, kind="stable")
            done, step = 0, 1
            while done < len(order) and bounds[order[done]] >= lowest:
                chosen = order[done:done + step]
                chosen = chosen[bounds[chosen] >= lowest]
                fresh = np.concatenate([docs[edges[b]:edges[b + 1]] for b in chosen])
                fresh = fresh[~seen[fresh]]
                seen[fresh] = True
                if len(fresh):
                    lowest = keep(fresh, self.scores(fresh, asked))
                done, step = done + step, step * 4


class Best:
    """The best documents of an item so far: by falling score, then rising id (null last)."""

    def __init__(self, size: int):
        self.size, self.rows = size, []

    @property
    def lowest(self) -> int:
        """Score that a further document needs at least."""
        return self.rows[-1][0] if len(self.rows) == self.size else 1

    def add(self, ids: list, scores: np.ndarray) -> int:
        good = np.flatnonzero(scores >= self.lowest)
        if len(good) > self.size:
            border = np.partition(scores[good], -self.size)[-self.size]
            good = good[scores[good] >= border]
        self.rows += [(int(scores[g]), ids[g]) for g in good]
        self.rows.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        del self.rows[self.size:]
        return self.lowest


def search_block(counted: DataFrame, items: Items, size: int) -> DataFrame:
    """``no``, ``id`` and ``score`` of the best documents of each item in each task."""
    shared = counted.sparkSession.sparkContext.broadcast((items.terms, items.weights, items.n_docs, items.n_terms))

    def search(rows: Iterator[dict]) -> Iterator[tuple]:
        terms, weights, n_docs, n_terms = shared.value
        known = Items({}, terms, weights, n_docs, n_terms)
        directions = np.random.default_rng(1).choice([-1.0, 1.0], (len(weights), SKETCH)).astype(np.float32)
        best = {no: Best(size) for no in terms}
        held: tuple[list, ...] = ([], [], [], [], [])

        def flush() -> None:
            ids, lengths, sizes, numbers, tfs = held
            if ids:
                portion = Portion(known, directions, lengths, sizes, numbers, tfs)
                for no, asked in terms.items():
                    own = best[no]
                    portion.search(asked, own.lowest, lambda docs, scores: own.add([ids[d] for d in docs.tolist()], scores))
            for column in held:
                column.clear()

        for row in rows:
            if not row["terms"]:
                continue
            for column, value in zip(held[:3], (row["id"], row["n"], len(row["terms"]))):
                column.append(value)
            held[3].extend(row["terms"])
            held[4].extend(row["tfs"])
            if len(held[3]) >= POSTINGS:
                flush()
        flush()
        for no, own in best.items():
            for score, ident in own.rows:
                yield no, ident, score

    schema = StructType([StructField("no", LongType()), counted.schema["id"], StructField("score", LongType())])
    return map_rows(counted.select("id", "n", "terms", "tfs"), schema, search)


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", size: int = 10,
                   block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``size`` best documents of every item: the item's id, ``rank``, the document's id and ``score``.

    A term's weight is ``floor(1000 * ln((2N + 2) / (2df + 1)))``; a document scores the sum over the item's distinct
    terms of ``w * (10^9 tf div (1000 tf + 8m))`` with ``m = 10 + 90 n N div L`` for its length ``n``. Equal scores
    come by ascending id, null ids last.

    Every row of ``items`` is an item of its own, so repeated ids have their ranks each. Null texts have no terms;
    such items and documents get no rows. Every row of ``docs`` is a document; repeated rows are ranked each. Items are
    searched in blocks of about ``block_terms`` terms, all documents for each block. Extra columns are left out.
    """
    named, blocks = item_blocks(items, item_col, item_text, block_terms)
    found: DataFrame | None = None
    for number in range(blocks):
        rows = named.where(F.col("block") == number).select("no", "terms").toArrow().to_pylist()
        vocabulary = {t: i for i, t in enumerate(sorted({t for row in rows for t in row["terms"]}))}
        block = Items(vocabulary, {row["no"]: np.array([vocabulary[t] for t in row["terms"]], np.int64)
                                   for row in rows if row["terms"]})
        counted = count_terms(docs, block, id_col, text_col)
        block.weigh(counted)
        best = search_block(counted, block, size)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    return (ranked.join(named.select("no", "item"), "no")
            .select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
