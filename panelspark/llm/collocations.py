"""Collocations by prefix-free parsing: n-grams are counted in distinct chunks, weighted by how often a chunk occurs.

Texts are cut into pieces at punctuation, and pieces into overlapping chunks wherever a window of ``OVERLAP`` words has a
hash that triggers. The cut depends on the words alone, so equal passages give equal chunks whatever stands around
them, and as every chunk ends with a trigger window (or its piece), none is a proper prefix of another. Neighbours share
the trigger window. It holds one word less than the longest phrase, so each phrase lies whole in the chunk where it
starts, and only there it counts: the starts inside the closing window belong to the next chunk.

Counting goes by length. A phrase can reach the minimum only if its first and last words without one do, so each
round counts, by hash, the phrases whose parts passed. Passing hashes are held in bit tables of fixed size, which may
let too many through but never too few. Words are counted as text. A longer phrase is counted by its hash and the hash
of its last word, from which the hash of the words before follows, so its text is put together by joins of the frequent
phrases alone: the phrase of one word less, and the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize
from .arrow import as_bytes

MAX_WORDS = 5
OVERLAP = MAX_WORDS - 1  # words of a trigger window
PERIOD = np.uint64(16)  # one window in so many triggers
TABLE_BITS = 26  # a bit table takes 8 MB
HELD_GRAMS = 1 << 20  # distinct phrases a task sums before it passes them on
PORTION = 1 << 20  # bytes of texts that are laid out at a time, at least one text
BLOCK = 1 << 18  # bytes of words that are hashed at a time, at least one word
NO_LANG = "und"

WORD, BLANK, CUT = 0, 1, 2
KINDS = np.zeros(256, np.uint8)
KINDS[list(b" \t")] = BLANK
KINDS[list(b".,;:!?\n\x0b\x0c\r")] = CUT
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
MIX_BACK, STEP_BACK = (np.uint64(pow(int(odd), -1, 1 << 64)) for odd in (MIX, STEP))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(29))


def unmixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29)) ^ (values >> np.uint64(58))) * MIX_BACK
    return values ^ (values >> np.uint64(32))


def factor(place: np.ndarray) -> np.ndarray:
    """A fixed odd factor per place in a word."""
    return mixed(mixed((place.astype(np.uint64) + np.uint64(1)) * STEP)) | np.uint64(1)


LETTERS = mixed(mixed(np.arange(1, 257, dtype=np.uint64) * MIX))
FACTORS = factor(np.arange(1024))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at ``starts``, one run after the other."""
    first = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - first, sizes)


def blocks(sizes: np.ndarray, bound: int) -> Iterator[tuple[int, int]]:
    """Cuts runs into blocks of about ``bound`` in all, at least one run each."""
    if len(sizes):
        group = np.cumsum(sizes) // bound
        edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(sizes)]
        yield from zip(edges, edges[1:])


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: the sum of letter times factor of the place, mixed with the length."""
    sizes, out = ends - starts, np.zeros(len(starts), np.uint64)
    for low, high in blocks(sizes, BLOCK):
        own = sizes[low:high]
        place = ragged(np.zeros(len(own), np.int64), own)
        factors = FACTORS[place] if own.max() <= len(FACTORS) else factor(place)
        letters = LETTERS[data[ragged(starts[low:high], own)]]
        out[low:high] = np.add.reduceat(letters * factors, np.cumsum(own) - own)
    return mixed(out + sizes.astype(np.uint64) * STEP)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of texts without nulls, and the edges of its rows."""
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[edges[0]:edges[-1]], edges - edges[0]


class Words:
    """Words of rows of texts: where they begin and end, their rows, hashes, and ends of their pieces (as words)."""

    def __init__(self, data: np.ndarray, edges: np.ndarray):
        self.data = LOWER[data]
        kinds = KINDS[data]
        inside = kinds == WORD
        before, after = np.append(False, inside[:-1]), np.append(inside[1:], False)
        filled = np.flatnonzero(edges[1:] > edges[:-1])
        before[edges[filled]] = False
        after[edges[filled + 1] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.rows = np.searchsorted(edges, self.starts, side="right") - 1
        piece = np.searchsorted(np.flatnonzero(kinds == CUT), self.starts)
        new = (np.diff(piece, prepend=-1) != 0) | (np.diff(self.rows, prepend=-1) != 0)
        self.pieces = np.flatnonzero(new)
        sizes = np.diff(np.append(self.pieces, len(new)))
        self.piece_ends = np.repeat(self.pieces + sizes, sizes)
        self.hashes = hashes_of(self.data, self.starts, self.ends)


def longer(grams: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the phrases of ``n`` words from those of ``n - 1`` words, by start; the last ones have no meaning."""
    if not len(words):
        return grams
    return mixed(grams * STEP + np.roll(words, 1 - n))


def without_last(grams: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases without their last words, from their hashes and those of the last words."""
    return (unmixed(grams) - last) * STEP_BACK


def cut_chunks(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-last word of every chunk, and the number of phrase starts that belong to it."""
    count = len(words.starts)
    windows = words.hashes
    for size in range(2, OVERLAP + 1):
        windows = longer(windows, words.hashes, size)
    opens = (windows % PERIOD == 0) & (np.arange(count) + OVERLAP <= words.piece_ends)
    opens[words.pieces] = True
    starts = np.flatnonzero(opens)
    ends = words.piece_ends[starts]
    following = np.append(starts, count)[1:]
    return starts, np.where(following < ends, following + OVERLAP, ends), np.minimum(following, ends) - starts


def joined(words: Words, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, pa.Array]]:
    """Texts of chunks (words joined by spaces) in blocks: from which to which chunk, and their texts."""
    for low, high in blocks(words.ends[ends - 1] - words.starts[starts], PORTION):
        sizes = ends[low:high] - starts[low:high]
        at = ragged(starts[low:high], sizes)
        last = np.zeros(len(at), bool)
        last[np.cumsum(sizes) - 1] = True
        lengths = words.ends[at] - words.starts[at] + ~last
        places = ragged(words.starts[at], lengths)
        data = words.data[np.minimum(places, len(words.data) - 1)]
        edges = np.cumsum(lengths)
        data[edges[~last] - 1] = 32
        offsets = np.append(0, edges[last]).astype(np.int32)
        yield low, high, pa.StringArray.from_buffers(high - low, pa.py_buffer(offsets), pa.py_buffer(data))


def dictionary(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Distinct chunks per language: ``lang``, ``chunk``, ``starts`` and ``n``, how often it occurs."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       as_bytes(text_col).alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, edges = bytes_of(batch["text"])
            for low, high in blocks(np.diff(edges), PORTION):
                words = Words(data[edges[low]:edges[high]], edges[low:high + 1] - edges[low])
                starts, ends, cores = cut_chunks(words)
                langs = batch["lang"].slice(low, high - low)
                for a, b, texts in joined(words, starts, ends):
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(words.rows[starts[a:b]])), texts, pa.array(cores[a:b].astype(np.int32))],
                        names=["lang", "chunk", "starts"])

    parsed = rows.mapInArrow(parse, "lang string, chunk string, starts int")
    return materialize(parsed.groupBy("lang", "chunk", "starts").agg(F.count("*").alias("n")), "chunks")


def bit_table(spark: SparkSession, hashes: DataFrame) -> Broadcast:
    """Bit table of the column ``h``; its words are combined on the executors, and at most 8 MB reach the driver."""
    slot = F.shiftrightunsigned("h", 64 - TABLE_BITS)
    bits = (hashes.select(F.shiftright(slot, 6).cast("int").alias("at"),
                          F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - TABLE_BITS}) & 63 AS INT))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    table = np.zeros(1 << TABLE_BITS - 6, np.int64)
    table[bits["at"].to_numpy()] = bits["bits"].to_numpy()
    return spark.sparkContext.broadcast(table)


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return (table[slot >> 6] >> (slot & 63) & 1).astype(bool)


class Sums:
    """Sums per 64-bit key and last word, handed out when they become many."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, keys: np.ndarray, last: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
        self.held.append((keys, last, values))
        self.size += len(keys)
        if self.size >= 2 * HELD_GRAMS:
            folded = self.folded()
            self.held, self.size = [folded], len(folded[0])
            if self.size >= HELD_GRAMS:
                yield folded
                self.held, self.size = [], 0

    def folded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, last, values = map(np.concatenate, zip(*self.held))
        keys, values, first = summed(keys, values, last)
        return keys, last[first], values


def summed(keys: np.ndarray, values: np.ndarray, last: np.ndarray | None = None
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of their values, and the first place of each; equal keys of other ``last`` stay apart."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1])[:len(keys)]
    if last is not None and len(keys):
        new[1:] |= last[order[1:]] != last[order[:-1]]
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(values[order], starts) if len(keys) else values
    return ranked[starts], sums, order[starts]


class Vocabulary:
    """Words of a task with their languages and sums, found by hash."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys, self.sums, self.texts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)

    def add(self, keys: np.ndarray, sums: np.ndarray, name) -> None:
        """Add sums of distinct keys in rising order; ``name`` gives languages and words at places that are new here."""
        place = np.searchsorted(self.keys, keys)
        old = np.zeros(len(keys), bool)
        near = place < len(self.keys)
        old[near] = self.keys[place[near]] == keys[near]
        self.sums[place[old]] += sums[old]
        new = np.flatnonzero(~old)
        if len(new):
            texts = np.empty(len(new), object)
            texts[:] = name(new)
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.sums = np.insert(self.sums, place[new], sums[new])
            self.texts = np.insert(self.texts, place[new], texts)

    def handed_out(self) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(self.keys), 1 << 14):
            langs, words = zip(*self.texts[s:s + (1 << 14)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.keys[s:s + (1 << 14)].view(np.int64)), pa.array(langs),
                 pa.array([w.decode() for w in words]), pa.array(self.sums[s:s + (1 << 14)])],
                names=["h", "lang", "phrase", "f"])
        self.clear()


def sum_batches(df: DataFrame, work) -> DataFrame:
    """Sum the (keys, last words, values) that ``work`` finds in each batch, per task first, then over all: ``h``,
    ``last``, ``f``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()

        def out(keys: np.ndarray, last: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
            for s in range(0, len(keys), 1 << 16):
                part = slice(s, s + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part].view(np.int64)), pa.array(last[part].view(np.int64)), pa.array(values[part])],
                    names=["h", "last", "f"])

        for found in work(batches):
            for full in sums.add(*found):
                yield from out(*full)
        yield from out(*sums.folded())

    return df.mapInArrow(run, "h bigint, last bigint, f bigint").groupBy("h", "last").agg(F.sum("f").alias("f"))


def with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted phrases with ``first``, the hash of their words before the last."""
    for batch in batches:
        first = without_last(*(batch[c].to_numpy().view(np.uint64) for c in ("h", "last")))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first.view(np.int64))], names=["h", "last", "f", "first"])


def word_rows(batch: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a batch of chunks, their odd hashes in their language, and the first and past-last word of each."""
    words = Words(*bytes_of(batch["chunk"]))
    langs = batch["lang"].dictionary_encode()
    seeds = np.array([xxhash.xxh64_intdigest(lang.encode(), seed=1) for lang in langs.dictionary.to_pylist()], np.uint64)
    own = mixed(words.hashes ^ seeds[langs.indices.to_numpy()][words.rows]) | np.uint64(1)
    return words, own, words.pieces, np.append(words.pieces[1:], len(own))


def reach(starts: np.ndarray, ends: np.ndarray, counted: np.ndarray, weights: np.ndarray):
    """Per word: whether phrases that start there count, words left in the chunk, weight of the chunk."""
    sizes = ends - starts
    at = np.arange(sizes.sum())
    return (at - np.repeat(starts, sizes) < np.repeat(counted, sizes), np.repeat(ends, sizes) - at,
            np.repeat(weights, sizes))


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100
                  ) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to 5 words that occur at least ``min_count`` times in a language, and the words per language.

    The first frame holds ``lang``, ``k`` (words), ``phrase`` (joined by spaces) and ``f``; the second ``lang`` and
    ``n``. A-Z count as lower case; pieces end at ``.,;:!?`` and line ends; words are runs without blanks and tabs.
    """
    spark = docs.sparkSession
    chunks = dictionary(docs, text_col, lang_col)
    totals = chunks.groupBy("lang").agg(F.sum(F.col("starts") * F.col("n")).alias("n"))

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Vocabulary()
        for batch in batches:
            words, own, starts, ends = word_rows(batch)
            raw, langs = words.data.tobytes(), batch["lang"].to_pylist()
            counts, _, weights = reach(starts, ends, batch["starts"].to_numpy(), batch["n"].to_numpy())
            keys, sums, first = summed(own[counts], weights[counts])
            at = np.flatnonzero(counts)[first]
            held.add(keys, sums, lambda new: [(langs[row], raw[s:e]) for row, s, e in zip(
                words.rows[at[new]].tolist(), words.starts[at[new]].tolist(), words.ends[at[new]].tolist())])
            if len(held.keys) >= HELD_GRAMS:
                yield from held.handed_out()
        yield from held.handed_out()

    counted = (chunks.mapInArrow(singles, "h bigint, lang string, phrase string, f bigint")
               .groupBy("h", "lang", "phrase").agg(F.sum("f").alias("f")))
    found = [materialize(counted.where(F.col("f") >= min_count), "phrases")]
    tables = [bit_table(spark, found[0].select("h"))]

    # Hashes of the words, 0 for words that are too rare: what the following rounds read instead of the texts.
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, own, starts, ends = word_rows(batch)
            own = np.where(passes(tables[0].value, own), own, np.uint64(0))
            lists = pa.LargeListArray.from_arrays(pa.array(np.append(starts, ends[-1:])), pa.array(own.view(np.int64)))
            yield pa.RecordBatch.from_arrays([lists.cast(pa.list_(pa.int64())), batch["starts"], batch["n"]],
                                             names=["words", "starts", "n"])

    words = materialize(chunks.mapInArrow(keep, "words array<bigint>, starts int, n bigint")
                        .where(F.exists("words", lambda w: w != 0)), "words")

    def grams(k: int, parts: Broadcast | None):
        def count(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                lists = batch["words"]
                edges = lists.offsets.to_numpy().astype(np.int64)
                own = lists.flatten().to_numpy().view(np.uint64)
                starts, ends = edges[:-1] - edges[0], edges[1:] - edges[0]
                counts, left, weights = reach(starts, ends, batch["starts"].to_numpy(), batch["n"].to_numpy())
                ok, shorter = own != 0, own
                for size in range(2, k):
                    shorter = longer(shorter, own, size)
                if parts is not None:
                    ok = ok & passes(parts.value, shorter)
                good = counts & (left >= k) & ok & np.roll(ok, -1)
                for size in range(2, k + 1):
                    good &= np.roll(own, 1 - size) != 0
                grams_, last, weights = longer(shorter, own, k)[good], np.roll(own, 1 - k)[good], weights[good]
                keys, sums, first = summed(grams_, weights, last)
                yield keys, last[first], sums
        return count

    last_words = found[0].select(F.col("h").alias("last"), F.col("phrase").alias("word"))
    for k in range(2, MAX_WORDS + 1):
        counted = sum_batches(words, grams(k, tables[-1] if k > 2 else None)).where(F.col("f") >= min_count)
        before = found[-1].select(F.col("h").alias("first"), "lang", "phrase")
        named = (counted.mapInArrow(with_first, "h bigint, last bigint, f bigint, first bigint")
                 .join(before, "first").join(last_words, "last")
                 .select("h", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "f"))
        found.append(materialize(named, "phrases"))
        if k < MAX_WORDS:
            tables.append(bit_table(spark, found[-1].select("h")))

    counts = [f.select("lang", F.lit(k).alias("k"), "phrase", "f") for k, f in enumerate(found, 1)]
    return reduce(DataFrame.unionByName, counts), materialize(totals, "words")


def wide(name: str) -> Column:
    return F.col(name).cast("decimal(18,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100,
                 top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase of 2 to 5 words that occurs ``a >= min_count`` times is cut where ``floor(1000 * a * n / (l * r))`` is
    smallest, the earliest of equal cuts; ``l`` and ``r`` count its sides, ``n`` all words of the language. A phrase
    goes if a longer one that contains it occurs as often. It is enough to look at phrases of one word more: a phrase
    between the two occurs as often as both. Order: score, then ``a`` (both falling), then the phrase by its bytes.

    Null texts are empty, a null language is ``und``. Rows that repeat count each time, whatever their id; no id is
    asked for. Texts of any length are parsed whole. Extra columns are left out. No frequent phrase gives no rows.
    Counts may reach 10^18; products are decimals of 38 digits.
    """
    counts, totals = phrase_counts(docs, text_col, lang_col, min_count)
    part = counts.select("lang", "phrase", "f")
    longer_ = counts.where("k >= 2").select("lang", "k", "phrase", F.col("f").alias("a"))
    cuts = (longer_.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
            .withColumn("first", F.expr("substring_index(phrase, ' ', cut)"))
            .withColumn("rest", F.expr("substr(phrase, length(first) + 2)")))
    sides = (cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
             .join(part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
             .join(totals, "lang")
             .withColumn("over", wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)"))
             .withColumn("under", wide("l") * wide("r"))
             .withColumn("score", F.expr("over div under")))
    sides = materialize(sides.select("lang", "k", "phrase", "a", "cut", "first", "rest", "l", "r", "n", "score"), "cuts")

    best = sides.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "n", "score"),
                                                        F.struct("score", "cut")).alias("best"))
    inside = (sides.where("k > 2 AND cut = k - 1 AND l = a").select("lang", F.col("first").alias("phrase"))
              .unionByName(sides.where("k > 2 AND cut = 1 AND r = a").select("lang", F.col("rest").alias("phrase"))))
    kept = best.join(inside, ["lang", "phrase"], "left_anti").select("lang", "phrase", "best.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
