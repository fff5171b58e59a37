"""Toxicity scores of a factorization machine over hashed terms.

Terms are words and their beginnings, hashed. The machine learns a weight for each term and a small vector whose inner
products weigh pairs of terms that stand in one text, which weights that only add up cannot. No term is tested against
the labels by itself, for it may tell only beside another one; shrinkage in the fit takes the useless ones to nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .arrow import Remembered, as_bytes, kept, map_rows, map_texts

SAMPLE_DOCS = 6_000   # labelled rows of either label that the machine is fitted on
HASH_BITS = 24
MIN_DOCS = 5          # sampled documents that must hold a term; every such term gets a weight and a vector
FACTORS = 8
PAIR_TERMS = 32       # the pairs of a text of n terms weigh 32 / (32 + n) each, for they grow with the square
PREFIXES = (4, 5, 6)
KNOWN_WORDS = 48 << 20  # bytes of words and their places that a task remembers
THRESHOLD = 0.3

WORD = re.compile(r"\w+")


def hashed(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "replace")) >> (32 - HASH_BITS)


def terms_of_word(word: str) -> list[int]:
    """Hashes of the whole word and of its beginnings."""
    return [hashed("=" + word)] + [hashed("^" + word[:n]) for n in PREFIXES if len(word) > n]


def words_of(text: bytes) -> set[str]:
    return set(WORD.findall(text.decode("utf-8", "replace").lower()))


def pair_share(n):
    return PAIR_TERMS / (PAIR_TERMS + n)


class Machine:
    """score = sigmoid(bias + sum of weights + pairwise inner products of the vectors of a text's terms).

    In a text of n terms the pairs count PAIR_TERMS / (PAIR_TERMS + n) each, at every length.
    """

    def __init__(self, terms: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.bias, self.weights, self.vectors = bias, weights, vectors
        self.place = {int(t): i for i, t in enumerate(terms)}

    def score(self, at: np.ndarray) -> float:
        total = self.bias
        if len(at):
            v = self.vectors[at]
            total += self.weights[at].sum() + pair_share(len(at)) * 0.5 * (v.sum(axis=0) ** 2 - (v ** 2).sum(axis=0)).sum()
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def fit(rows: list[np.ndarray], labels: np.ndarray, importance: np.ndarray, terms: np.ndarray, steps: int = 600,
        batch: int = 256, step: float = 0.05, shrink: float = 1e-3, decay: float = 1e-3, seed: int = 7) -> Machine:
    """Logistic loss, ``steps`` mini-batches of Adagrad. ``rows`` hold places in ``terms``, each once and in order.

    Weights are drawn to zero by ``shrink`` (the sum of their sizes), vectors by ``decay`` (the sum of squares). A batch
    touches only the terms it holds.
    """
    rng = np.random.default_rng(seed)
    k = len(terms)
    table = np.zeros((k, 1 + FACTORS), np.float32)  # the weight, then the vector
    table[:, 1:] = rng.normal(0, 0.01, (k, FACTORS))
    # Vectors start slowly: only pairs that go on pulling the same way outgrow the decay.
    grown = np.full((k, 1 + FACTORS), 0.01, np.float32)
    grown[:, 0] = 1e-6
    drawn = np.array([0.0] + [decay] * FACTORS, np.float32)
    share = float((labels * importance).sum() / importance.sum())
    bias, bias_grown = float(np.log(share / (1 - share))), 1e-6
    waiting = np.zeros(0, np.int64)
    for _ in range(steps):
        if len(waiting) == 0:
            waiting = rng.permutation(len(rows))
        part, waiting = waiting[:batch], waiting[batch:]
        sizes = np.array([len(rows[r]) for r in part])
        held = np.concatenate([rows[r] for r in part])
        text = np.repeat(np.arange(len(part)), sizes)
        order = np.argsort(held, kind="stable")
        first = np.flatnonzero(np.diff(held[order], prepend=-1))
        touched = held[order][first]
        x = table[held]
        summed, squares = np.zeros((len(part), 1 + FACTORS), np.float32), np.zeros((len(part), FACTORS), np.float32)
        if len(held):
            starts = (np.cumsum(sizes) - sizes)[sizes > 0]
            summed[sizes > 0] = np.add.reduceat(x, starts, axis=0)
            squares[sizes > 0] = np.add.reduceat(x[:, 1:] ** 2, starts, axis=0)
        pairs = pair_share(sizes)
        total = bias + summed[:, 0] + 0.5 * pairs * (summed[:, 1:] ** 2 - squares).sum(axis=1)
        error = (1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels[part]) * importance[part] / len(part)
        bias_grown += error.sum() ** 2
        bias -= step * error.sum() / np.sqrt(bias_grown)
        if not len(held):
            continue
        # Each text holds a term once, so the pair gradient of a term is the sum of the others' vectors.
        pulls = np.column_stack([error, (error * pairs)[:, None] * summed[:, 1:], error * pairs]).astype(np.float32)
        pulls = np.add.reduceat(pulls[text[order]], first, axis=0)
        own = table[touched]
        slope = pulls[:, :-1] + drawn * own
        slope[:, 1:] -= pulls[:, -1:] * own[:, 1:]
        grown[touched] += slope ** 2
        rate = step / np.sqrt(grown[touched])
        own -= rate * slope
        own[:, 0] = np.sign(own[:, 0]) * np.maximum(np.abs(own[:, 0]) - shrink * rate[:, 0], 0)
        table[touched] = own
    return Machine(terms, bias, table[:, 0], table[:, 1:])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS, min_docs: int = MIN_DOCS) -> Machine | None:
    """Fit on at most ``sample_docs`` rows of either label, drawn by hash of the id, whose crc32(id) mod 4 is not 2.

    An id counts as toxic if any of its labels says so. Rows of the rarer label are not weighed up: each label counts
    with its share among all usable labelled rows. Of the rows that repeat an id the smallest text is taken. Every term that stands in ``min_docs`` sampled rows takes part, however
    its rates under the labels compare. None if one of the labels does not occur.
    """
    known = (labels.where("toxic IS NOT NULL").groupBy(F.col(id_col).alias("__tx_id"))
             .agg(F.max("toxic").cast("int").alias("y")).where(F.crc32(F.col("__tx_id").cast("string")) % 4 != 2))
    present = materialize(
        known.join(docs.select(F.col(id_col).alias("__tx_id")).distinct(), "__tx_id", "left_semi"), "labelled")
    totals = {r["y"]: r["count"] for r in present.groupBy("y").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return None
    drawn = None
    for label in (0, 1):
        part = present.where(F.col("y") == label).orderBy(F.xxhash64("__tx_id"), "__tx_id").limit(sample_docs)
        drawn = part if drawn is None else drawn.unionByName(part)
    drawn = materialize(drawn, "sample")

    def hashes(incoming: Iterator[dict]) -> Iterator[tuple]:
        for row in incoming:
            found = {h for w in words_of(row["t"]) for h in terms_of_word(w)}
            yield row["y"], sorted(found)

    # One text per id: an id that is repeated without end is one sampled row.
    rows = (docs.join(drawn, F.col(id_col) == F.col("__tx_id")).groupBy("__tx_id")
            .agg(F.max("y").alias("y"), F.min(F.col(text_col)).alias("t")).select("y", as_bytes("t").alias("t")))
    sample = materialize(map_rows(rows, "y int, terms array<int>", hashes), "terms")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    often = (sample.select(F.explode("terms").alias("term")).groupBy("term").count()
             .where(F.col("count") >= min_docs).select("term").toArrow())
    terms = np.sort(often["term"].to_numpy().astype(np.int64))

    def places(incoming: Iterator[dict]) -> Iterator[tuple]:
        for row in incoming:
            found = np.intersect1d(np.array(row["terms"], np.int64), terms, assume_unique=True)
            yield row["y"], np.searchsorted(terms, found).astype(np.int32).tobytes()

    data = map_rows(sample, "y int, at binary", places).toArrow().to_pylist()
    data.sort(key=lambda r: (r["y"], r["at"]))  # the same model whatever the order of partitions
    labels_ = np.array([r["y"] for r in data], float)
    importance = np.array([totals[r["y"]] / sizes[r["y"]] for r in data])
    return fit([np.frombuffer(r["at"], np.int32) for r in data], labels_, importance / importance.mean(), terms)


def score(docs: DataFrame, model: Machine | None, keep: Sequence[str] = ("doc_id",), text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """The ``keep`` columns of every row with ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (0 or 1).

    Only the text is looked at. Null or empty text has the score of the bias alone; without a model every score is 0.
    Rows that repeat an id or a text are scored each; null ids stay. Whole texts are read, however long. An empty
    table gives an empty table. Kept columns must not be called ``score`` or ``predicted``; other input columns are
    not looked at.
    """
    # A worker holds one copy of a broadcast for all its tasks, and so keeps what it remembers of words between them.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def begin() -> Callable[[bytes], tuple]:
        model = shared.value
        known = kept(("toxicity", id(model)), lambda: Remembered(
            lambda word: tuple(model.place[h] for h in terms_of_word(word) if h in model.place), KNOWN_WORDS))

        def rate(text: bytes) -> tuple:
            value = 0.0
            if model is not None:
                at: set[int] = set()
                for word in words_of(text):
                    at.update(known[word])
                value = model.score(np.array(sorted(at), np.int64))
            return value, int(value >= threshold)

        return rate

    return map_texts(docs, list(keep), text_col, "score double, predicted int", begin)
