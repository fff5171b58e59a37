"""SimHash fingerprints, and the documents within a Hamming radius by permuted block tables.

Every distinct word of a text votes on each bit with the matching bit of its hash; its weight grows with the root of its
count and with its rarity over the whole corpus. Document frequencies live in a hashed table of fixed size, so words
may share a place but none is left out. Weights are whole numbers: equal texts get equal fingerprints in any order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .arrow import as_bytes, extend, map_rows

BITS = 128
SLOTS = 1 << 18  # places of the table of document frequencies
CACHED_BYTES = 16 << 20  # words a task remembers with their hashes
CACHED_WORD = 64
BUCKET = 4096  # fingerprints of a bucket that meet in one comparison; larger buckets are cut into tiles
SCALE = 16  # steps of a weight


class Words:
    """Hashes of the words of a text, remembered up to a number of bytes."""

    def __init__(self):
        self.known: dict[bytes, bytes] = {}
        self.free = CACHED_BYTES

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes (a row of two 64-bit numbers each) and counts of the distinct words."""
        counts = Counter(text.lower().split())
        found = b"".join([self.known.get(w) or self.add(w) for w in counts])
        return (np.frombuffer(found, "<u8").reshape(len(counts), 2),
                np.fromiter(counts.values(), np.float64, len(counts)))

    def add(self, word: bytes) -> bytes:
        digest = xxhash.xxh128_digest(word)
        if len(word) <= CACHED_WORD:
            self.free -= len(word) + 150
            if self.free < 0:
                self.known.clear()
                self.free = CACHED_BYTES
            self.known[word] = digest
        return digest


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes[:, 0] ^ (hashes[:, 1] >> np.uint64(9))) * np.uint64(0x9E3779B97F4A7C15)
            >> np.uint64(46)).astype(np.int64)


@dataclass
class Rarity:
    """Weight of a word by its place in the table of document frequencies."""

    weights: np.ndarray

    def fingerprint(self, words: Words, text: bytes) -> bytes:
        hashes, counts = words(text)
        weights = np.rint(self.weights[slots_of(hashes)] * np.sqrt(counts))
        bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8), axis=1) if len(counts) else np.zeros((0, BITS))
        return np.packbits(2 * (weights @ bits) > weights.sum()).tobytes()


def rarity(docs: DataFrame, text_col: str = "text") -> Rarity:
    """Weights from the document frequencies of all words of all rows. At most ``SLOTS`` numbers reach the driver."""

    def count(rows: Iterator[dict]) -> Iterator[tuple]:
        words, seen, n = Words(), np.zeros(SLOTS, np.int64), 0
        for row in rows:
            hashes, _ = words(row["text"])
            seen[np.unique(slots_of(hashes))] += 1
            n += 1
        for slot in np.flatnonzero(seen):
            yield int(slot), int(seen[slot])
        yield -1, n

    counted = map_rows(docs.select(as_bytes(text_col).alias("text")), "slot int, n bigint", count)
    found = counted.groupBy("slot").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    table, total = np.ones(SLOTS), 1
    for slot, n in zip(found["slot"], found["n"]):
        if slot < 0:
            total = max(n, 1)
        else:
            table[slot] = n
    return Rarity(np.rint(SCALE * np.log2(1 + total / table)))


def likeness(a: bytes, b: bytes) -> float:
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def halves(fingerprint: bytes) -> tuple[int, int]:
    return int.from_bytes(fingerprint[:8], signed=True), int.from_bytes(fingerprint[8:], signed=True)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of ``following``."""
    part = len(text) // 3
    return text[:len(text) - part] + following[:part]


RESULT = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
          "near_next double, hi bigint, lo bigint")
FIRST, LAST = 1, 2  # rows at the edges of a partition keep their text


def result_of(text: str, own: bytes, after: str, after_print: bytes, measure) -> tuple:
    changed = edited(text, after).encode()
    print_ = measure(changed)
    return (len(text), sha256(changed).hexdigest(), own.hex(), print_.hex(), likeness(own, print_),
            likeness(own, after_print), *halves(own))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      weights: Rarity | None = None) -> DataFrame:
    """Fingerprint of every text, of its edited text, and how like they and the next document's are.

    The next document is the one that follows in descending order of the id, after the last one the first. The edited
    text is the text with its last third of code points replaced by the beginning of the next document. Columns: the
    id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (hex), ``near_edited``, ``near_next``
    (share of equal bits), ``hi`` and ``lo`` (halves of the fingerprint).

    Documents are cut into ranges of the id once, with their texts; inside a range the next document is the next row,
    and only the texts at the edges of ranges meet again. Null texts are empty; an empty text has the fingerprint of
    all zeros. Null ids come last. Rows that repeat an id stand in order of a hash of the text; equal rows may change
    places. A single document follows itself. Extra columns are left out. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    shared: Broadcast = spark.sparkContext.broadcast(weights or rarity(docs, text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def walk(found: Iterator[dict]) -> Iterator[tuple]:
        words, part = Words(), TaskContext.get().partitionId()
        measure = lambda text: shared.value.fingerprint(words, text)
        before = None
        for row in found:
            own = measure(row["text"].encode())
            if before is None:
                yield (None, part, FIRST, row["text"], None, None, own.hex(), None, None, None, None, None)
            else:
                yield (before[0], part, 0, None, *result_of(*before[1:], row["text"], own, measure))
            before = row["id"], row["text"], own
        if before:
            yield (before[0], part, LAST, before[1], None, None, before[2].hex(), None, None, None, None, None)

    id_type = rows.schema["id"].dataType.simpleString()
    walked = materialize(map_rows(ranges, f"id {id_type}, part int, edge int, text string, {RESULT}", walk), "simhash")
    first = walked.where(F.col("edge") == FIRST)
    parts = Window.orderBy("part")  # one number per range
    follows = (first.select("part").withColumn("next", F.lead("part").over(parts))
               .withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy(F.lit(0))))))
    starts = first.select(F.col("part").alias("next"), F.col("text").alias("after"), F.col("fingerprint").alias("after_print"))
    edges = (walked.where(F.col("edge") == LAST).select("id", "part", "text", "fingerprint")
             .join(follows, "part").join(starts, "next"))

    def finish(found: Iterator[dict]) -> Iterator[tuple]:
        words = Words()
        for row in found:
            yield (row["id"], *result_of(row["text"], bytes.fromhex(row["fingerprint"]), row["after"],
                                         bytes.fromhex(row["after_print"]),
                                         lambda text: shared.value.fingerprint(words, text)))

    schema = extend(rows, ["id"], RESULT)
    inside = walked.where(F.col("edge") == 0).select("id", *StructType.fromDDL(RESULT).names)
    return inside.unionByName(map_rows(edges, schema, finish)).withColumnRenamed("id", id_col)


def blocks_of(blocks: int) -> list[tuple[int, int, int]]:
    """Half, lowest bit and width of every block; an even number of blocks, half of them in either half."""
    each = blocks // 2
    edges = [round(i * 64 / each) for i in range(each + 1)]
    return [(half, low, high - low) for half in (0, 1) for low, high in zip(edges, edges[1:])]


def block(place: tuple[int, int, int]) -> Column:
    half, low, width = place
    return F.shiftrightunsigned(F.col(("hi", "lo")[half]), low).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def within_radius(prints: DataFrame, radius: int = 4, blocks: int = 6, bucket: int = BUCKET) -> DataFrame:
    """``hi``, ``lo``, ``n`` and ``n_near`` of every distinct fingerprint: its rows, and all rows within ``radius`` bits.

    Fingerprints that differ in at most ``radius`` bits agree in at least ``blocks - radius`` of the blocks, so there is
    one table for each choice of so many blocks, and candidates share a bucket of a table. A pair counts in the first
    table that joins it, so no link is counted twice and none is lost. Equal fingerprints are one row throughout. A
    bucket with more than ``bucket`` fingerprints is cut into parts, and every pair of parts is a group of its own.
    Pairs never leave a task; only sums do. Rows with a null half take no part.
    """
    if not radius < blocks or blocks % 2:
        raise ValueError("blocks must be even and more than the radius")
    places = blocks_of(blocks)
    tables = list(combinations(range(blocks), blocks - radius))
    distinct = materialize(prints.where("hi IS NOT NULL AND lo IS NOT NULL").groupBy("hi", "lo")
                           .agg(F.count("*").alias("n")), "prints")
    keys = F.array(*[F.xxhash64(F.lit(t), *[block(places[b]) for b in chosen]) for t, chosen in enumerate(tables)])
    dealt = distinct.select("hi", "lo", "n", F.posexplode(keys).alias("place", "key"))
    large = (dealt.groupBy("place", "key").count().where(F.col("count") > bucket)
             .select("place", "key", F.ceil(F.col("count") / bucket).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64(F.lit(1), "hi", "lo"), parts).cast("int")
    tiles = (dealt.join(large, ["place", "key"], "left")
             .select("place", "key", "hi", "lo", "n", own.alias("own"),
                     F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
             .select("place", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own",
                     "hi", "lo", "n"))
    group = ["place", "key", "a", "b"]
    sorted_tiles = tiles.repartition(*group).sortWithinPartitions(*group)

    agree = np.zeros(1 << blocks, np.int64)  # blocks that agree -> the first table that needs no others
    for mask in range(1 << blocks):
        agree[mask] = next((t for t, chosen in enumerate(tables) if all(mask >> b & 1 for b in chosen)), -1)

    def joined(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, own: np.ndarray, place: int, a: int, b: int) -> np.ndarray:
        left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
        near = np.zeros(len(hi), np.int64)
        step = max(1, (1 << 20) // len(right)) if len(right) else 1
        for start in range(0, len(left), step):
            rows = left[start:start + step]
            x, y = hi[rows, None] ^ hi[None, right], lo[rows, None] ^ lo[None, right]
            i, j = np.nonzero(np.bitwise_count(x) + np.bitwise_count(y) <= radius)
            if a == b:
                i, j = i[rows[i] < right[j]], j[rows[i] < right[j]]
            both = (x[i, j], y[i, j])
            same = sum(((both[half] >> np.uint64(low)) & np.uint64((1 << width) - 1) == 0).astype(np.int64) << at
                       for at, (half, low, width) in enumerate(places))
            found = agree[same] == place
            i, j = rows[i[found]], right[j[found]]
            np.add.at(near, i, n[j])
            np.add.at(near, j, n[i])
        return near

    fields = pa.schema([(c, pa.int64()) for c in ("hi", "lo", "near")])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups(columns: list[np.ndarray], last: bool) -> tuple[list[np.ndarray], list[tuple]]:
            """Rows of the group that may go on, and sums of all others that have more than one row."""
            place, key, a, b, own, hi, lo, n = columns
            size = len(place)
            change = np.ones(size, bool)
            change[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            starts = np.append(np.flatnonzero(change), size)
            end = size if last else starts[-2]
            out = []
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s > 1 and e <= end:
                    near = joined(hi[s:e].view(np.uint64), lo[s:e].view(np.uint64), n[s:e], own[s:e],
                                  int(place[s]), int(a[s]), int(b[s]))
                    hit = np.flatnonzero(near)
                    if len(hit):
                        out.append((hi[s:e][hit], lo[s:e][hit], near[hit]))
            return [c[end:] for c in columns], out

        held: list[np.ndarray] | None = None
        for batch in batches:
            fresh = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = fresh if held is None else [np.concatenate(pair) for pair in zip(held, fresh)]
            if len(held[0]):
                held, sums = groups(held, last=False)
                for found in sums:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], schema=fields)
        if held is not None and len(held[0]):
            for found in groups(held, last=True)[1]:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], schema=fields)

    near = (sorted_tiles.select(*group, "own", "hi", "lo", "n")
            .mapInArrow(compare, "hi bigint, lo bigint, near bigint")
            .groupBy("hi", "lo").agg(F.sum("near").alias("near")))
    return (distinct.join(near, ["hi", "lo"], "left")
            .select("hi", "lo", "n", (F.col("n") + F.coalesce("near", F.lit(0))).alias("n_near")))
