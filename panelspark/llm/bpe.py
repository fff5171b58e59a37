"""BPE encoding and decoding with reuse of content-defined chunks.

Texts are cut where a rolling hash of their bytes says so, so equal passages give equal chunks wherever they stand. A
chunk that stands in several places is encoded once; joins between chunks are then repaired by re-encoding the text
around them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from ..session import materialize
from .arrow import Remembered, as_bytes, extend, kept, map_rows
from .token_counts import ALPHABET, load

WINDOW = 32          # bytes that the rolling hash sees
CUT_BITS = 9         # a cut after every 512 bytes on average
FILTER_BITS = 26     # bits of the filter that knows the chunks seen more than once: 8 MB at any data size
BITMAP_BYTES = 4096  # bytes of one bitmap of Spark's bitmap functions
BATCH_CHUNKS = 512
KNOWN_PIECES = 128 << 20  # bytes of pieces and their ids that a worker remembers
PASSED = 200_000     # chunks that a task remembers having passed on
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def cut(text: bytes) -> list[bytes]:
    """Chunks of a text; a cut depends on the ``WINDOW`` bytes before it alone and never splits a character."""
    if len(text) <= WINDOW:
        return [text] if text else []
    data = np.frombuffer(text, np.uint8)
    mixed = (data.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    mixed ^= mixed >> np.uint64(29)
    # Windowed hash of bytes as a polynomial in 3 modulo 2^64, by doubling the span.
    span, power = 1, 3
    while span < WINDOW:
        shifted = mixed[:-span] * np.uint64(power % 2 ** 64)
        mixed = shifted + mixed[span:]
        power = power * power % 2 ** 64
        span *= 2
    mixed = (mixed * MULTIPLIER) >> np.uint64(64 - CUT_BITS)
    ends = np.flatnonzero(mixed == 0) + WINDOW
    ends = ends[ends < len(text)]
    ends = ends[(data[ends] & 0xC0) != 0x80]
    edges = [0, *ends.tolist(), len(text)]
    return [text[a:b] for a, b in zip(edges, edges[1:])]


def chunk_hash(chunk: bytes) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(chunk)
    return (value >> 64) - 2 ** 63, (value & (2 ** 64 - 1)) - 2 ** 63


# Text of these characters without "<|" is split by the pattern below just as the tokenizer splits it.
PLAIN = re.compile(r"(?:[\t\n\r -;=-~À-ÖØ-öø-ÿ]|<(?!\|))*\Z")
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")


class ChunkEncoder:
    """Ids of texts as packed little-endian numbers; pieces of plain text are remembered, others go to the tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 2 ** 16 else "<u4"
        self.pieces = Remembered(self._piece, KNOWN_PIECES)

    def _piece(self, text: str) -> bytes:
        spelled = text.encode().decode("latin-1").translate(ALPHABET)
        return np.array([t.id for t in self.model.tokenize(spelled)], self.kind).tobytes()

    def encode(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if PLAIN.match(text):
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()


def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder for all tasks of a worker process."""
    return kept(("pieces", path), lambda: ChunkEncoder(path))


def encode_chunks(path: str, chunks: list[bytes]) -> list[bytes]:
    """Packed ids of each chunk by itself."""
    return [chunk_encoder(path).encode(c) for c in chunks]


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """Bytes of every token: byte-level alphabets write a byte as one printable character."""
    tokenizer: Tokenizer = load(path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    alphabet = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    table = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, number in tokenizer.get_vocab(with_added_tokens=True).items():
        known = all(c in alphabet for c in token)
        table[number] = bytes(alphabet[c] for c in token) if known else token.encode()
    return table


def joins_here(before: bytes, after: bytes) -> bool:
    """Whether a text can be split here without changing its tokens.

    The splitter never goes on from a visible ASCII character into white space, whatever stands around.
    """
    return 33 <= before[-1] <= 126 and after[0] in b" \n\t\r\x0b\x0c"


def repair(path: str, parts: Sequence[bytes]) -> np.ndarray:
    """Ids of the whole text from the ids of its chunks.

    Around each join, tokens back to the last and on to the next safe split are decoded and encoded again; with no
    safe split in a chunk the stretch grows into the next one, so the result agrees with encoding the whole text.
    """
    table, encoder = token_bytes(path), chunk_encoder(path)
    done: list[np.ndarray] = []
    open_ids = np.zeros(0, np.uint32)  # ids after the last safe split so far: the next join may change them
    first = True
    for part in parts:
        ids = np.frombuffer(part, encoder.kind)
        if first:
            settled, open_ids = split_last(ids, table)
            done.append(settled)
            first = False
            continue
        at = next((i for i in range(1, len(ids)) if joins_here(table[ids[i - 1]], table[ids[i]])), None)
        head = ids if at is None else ids[:at]
        again = np.frombuffer(encoder.encode(b"".join(table[i] for i in (*open_ids, *head))), encoder.kind)
        if at is None:
            settled, open_ids = split_last(again, table)
            done.append(settled)
        else:
            done.append(again)
            settled, open_ids = split_last(ids[at:], table)
            done.append(settled)
    done.append(open_ids)
    return np.concatenate(done).astype(np.uint32)


def split_last(ids: np.ndarray, table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    for i in range(len(ids) - 1, 0, -1):
        if joins_here(table[ids[i - 1]], table[ids[i]]):
            return ids[:i], ids[i:]
    return ids[:0], ids


def digests(path: str, ids: np.ndarray) -> tuple[int, str, str]:
    """Number of ids, checksum of their decimal list, checksum of the text that they decode to."""
    table, numbers = token_bytes(path), ids.tolist()
    decoded = b"".join(map(table.__getitem__, numbers)).decode("utf-8", "replace").encode()
    return (len(numbers), hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest(),
            hashlib.sha256(decoded).hexdigest())


def bitmap_place(value: int) -> tuple[int, int]:
    """Bucket and bit of a value from 0 on, as Spark's bitmap functions number them."""
    return (1 + (value - 1) // (8 * BITMAP_BYTES), (value - 1) % (8 * BITMAP_BYTES)) if value else (0, 0)


def shared_chunks(texts: DataFrame) -> dict[int, bytes]:
    """Filter of fixed size over the hashes of chunks that stand at least twice in the column ``__be_text``."""
    def hashes(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            found = [chunk_hash(c) for c in cut(row["__be_text"])]
            yield [a for a, _ in found], [b for _, b in found]

    listed = map_rows(texts.select("__be_text"), "h1 array<bigint>, h2 array<bigint>", hashes)
    again = (listed.select(F.explode(F.arrays_zip("h1", "h2")).alias("h")).select("h.h1", "h.h2")
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    place = F.pmod(F.col("h1"), F.lit(2 ** FILTER_BITS))
    maps = (again.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("at"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).toArrow().to_pylist())
    return {r["bucket"]: r["bits"] for r in maps}


def encode_documents(docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """The ``keep`` columns of every row with its encoding by the byte-level tokenizer file ``path``.

    Adds ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas), ``decoded_sha256`` (the text decoded from the
    ids) and, if asked for, ``ids`` (little-endian unsigned 32-bit). No special tokens are added; special strings in
    a text are single tokens, as the tokenizer reads them.

    Chunks that stand only once are encoded where they stand. A filter of fixed size, which may err only towards
    "seen again", tells which chunks are shared; these are encoded once and joined back by hash. The filter never
    changes a result.

    Null or empty text has no tokens. Rows that repeat an id or a text are encoded each, from shared chunks; null ids
    stay. Very long texts are read whole. An empty table gives an empty table. Kept columns must not carry the names
    of added ones; other input columns are not looked at.
    """
    spark, keep = docs.sparkSession, list(keep)
    source = docs.select(*keep, as_bytes(text_col).alias("__be_text"))
    shared = spark.sparkContext.broadcast(shared_chunks(source))

    def result(ids: np.ndarray) -> tuple:
        return *digests(path, ids), ids.astype("<u4").tobytes() if with_ids else None

    def encode(rows: Iterator[dict]) -> Iterator[tuple]:
        """Finished documents, documents that wait for shared chunks, and the texts of such chunks."""
        bitmaps = shared.value

        def seen_again(h1: int) -> bool:
            bucket, at = bitmap_place(h1 % 2 ** FILTER_BITS)
            bits = bitmaps.get(bucket)
            return bits is not None and bits[at >> 3] >> (at & 7) & 1 == 1

        passed: set[tuple[int, int]] = set()
        for row in rows:
            own = tuple(row[c] for c in keep)
            chunks = cut(row["__be_text"])
            keys = [chunk_hash(c) for c in chunks]
            wait = [at for at, key in enumerate(keys) if seen_again(key[0])]
            waiting = set(wait)
            here = [at for at in range(len(chunks)) if at not in waiting]
            ids: list[bytes] = []
            for at in range(0, len(here), BATCH_CHUNKS):
                ids += encode_chunks(path, [chunks[i] for i in here[at:at + BATCH_CHUNKS]])
            if not wait:
                yield *own, "done", *result(repair(path, ids)), *(None,) * 8
                continue
            yield (*own, "waits", *(None,) * 4, wait, [keys[i][0] for i in wait], [keys[i][1] for i in wait],
                   here, ids, *(None,) * 3)
            for at in wait:
                if keys[at] not in passed:
                    yield *(None,) * len(keep), "chunk", *(None,) * 9, *keys[at], chunks[at]
                    passed.add(keys[at])
            if len(passed) > PASSED:
                passed.clear()

    added = ("kind string, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary, "
             "wait array<int>, wait_h1 array<bigint>, wait_h2 array<bigint>, here array<int>, parts array<binary>, "
             "h1 bigint, h2 bigint, chunk binary")
    # A row number is only stable once it is stored together with the row.
    stored = materialize(map_rows(source, extend(docs, keep, added), encode)
                         .withColumn("__be_row", F.monotonically_increasing_id()), "encoded")

    def encode_shared(rows: Iterator[dict]) -> Iterator[tuple]:
        held: list[dict] = []

        def encoded() -> Iterator[tuple]:
            for r, ids in zip(held, encode_chunks(path, [r["chunk"] for r in held])):
                yield r["h1"], r["h2"], ids

        for row in rows:
            held.append(row)
            if len(held) == BATCH_CHUNKS:
                yield from encoded()
                held = []
        yield from encoded()

    texts = stored.where("kind = 'chunk'").groupBy("h1", "h2").agg(F.first("chunk").alias("chunk"))
    once = materialize(map_rows(texts, "h1 bigint, h2 bigint, part binary", encode_shared), "chunks")

    waits = stored.where("kind = 'waits'")
    wanted = (waits.select("__be_row", F.explode(F.arrays_zip("wait", "wait_h1", "wait_h2")).alias("w"))
              .select("__be_row", F.col("w.wait").alias("at"), F.col("w.wait_h1").alias("h1"),
                      F.col("w.wait_h2").alias("h2")))
    found = (wanted.join(once, ["h1", "h2"]).groupBy("__be_row")
             .agg(F.collect_list(F.struct("at", "part")).alias("got")))

    def assemble(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            parts = dict(zip(row["here"], row["parts"])) | {g["at"]: g["part"] for g in row["got"]}
            yield *(row[c] for c in keep), *result(repair(path, [parts[at] for at in range(len(parts))]))

    out = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary"
    complete = map_rows(waits.join(found, "__be_row").select(*keep, "here", "parts", "got"),
                        extend(docs, keep, out), assemble)
    finished = stored.where("kind = 'done'").select(*complete.columns)
    both = finished.unionByName(complete)
    return both if with_ids else both.drop("ids")
