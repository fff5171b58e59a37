"""Token counts without token ids: pieces are counted once per distinct pre-token and summed by frequency.

A pre-token here is a run of bytes without ASCII white space. The tokenizer's normaliser and splitter treat white
space as a boundary that no piece crosses, and its special strings hold no white space, so the pieces of a text are
exactly the pieces of its pre-tokens. The tokenizer itself counts them, special strings included.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

from ..session import materialize, small_batches
from .arrow import Remembered, RememberedColumn, as_bytes, extend, kept

FLUSH = 500_000     # counts of pre-tokens that a task holds before it passes them on
TEXTS_AT_ONCE = 1024  # texts that are split in one go
BATCH_WORDS = 1 << 14  # pre-tokens of a batch of counts
HEAD_ROWS = 200_000  # most frequent pre-tokens that every task knows ...
HEAD_BYTES = 64      # ... of at most this many bytes each: a bound of 12.8 MB
KNOWN_PARTS = 48 << 20  # bytes of plain parts and their ids that a worker remembers where words come one by one
KNOWN_WORDS = 32 << 20  # the same for words that are not plain
KNOWN_COLUMN = 8 << 20  # the same for plain parts as Arrow arrays, where words come together
WORDS_AT_ONCE = 1 << 18  # different words that are cut and looked up in one go
PARTS_AT_ONCE = 1 << 13  # new plain parts that one call of the model gets


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    """A tokenizer without padding and truncation, in one thread: Spark runs a task per core already."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


# Letters of ASCII and Latin-1, then ASCII punctuation other than the apostrophe. The normaliser only lower-cases such a
# word, and the splitter cuts it in two right there.
PARTS = r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)"
PLAIN = re.compile(PARTS + r"\Z")
# The same for bytes of UTF-8: a letter, a punctuation mark, either, or none. 0xC3 leads the letters of Latin-1.
LETTER, MARK = (np.array([bool(re.match(kind, chr(b))) for b in range(256)]) for kind in ("[A-Za-z]", "[!-&(-/:-@\\[-`{-~]"))
LEAD, FOLLOWING = 0xC3, np.array([128 <= b < 192 and b not in (0x97, 0xB7) for b in range(256)])
LOWER = np.array([b + 32 * (65 <= b <= 90) for b in range(256)], np.uint8)
LOWER_FOLLOWING = np.array([b + 32 * (0x80 <= b <= 0x9E) & 255 for b in range(256)], np.uint8)
# The byte-level alphabet writes these bytes as characters from 256 on, all others as themselves.
MOVED = [*range(33), *range(127, 161), 173]
ALPHABET = {byte: 256 + place for place, byte in enumerate(MOVED)}
SPELLED = np.array([ALPHABET.get(byte, byte) if byte != 10 else 10 for byte in range(256)], "<u4")  # line ends stay


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit bytes."""
    return struct.pack(f"<{len(ids)}I", *ids)


def binary_array(data: np.ndarray, edges: np.ndarray) -> pa.LargeBinaryArray:
    """Pieces of ``data`` between edges given in bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [
        None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def joined(pieces: pa.LargeBinaryArray, edges: np.ndarray) -> pa.LargeBinaryArray:
    """Runs of neighbouring pieces, between the given places, as one piece each; a fresh array from its first byte on."""
    _, offsets, data = pieces.buffers()
    places = np.frombuffer(offsets, np.int64)[edges]
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(places), data])


def upto(chosen: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many are chosen before each edge."""
    total = np.zeros(len(chosen) + 1, np.int32)
    np.cumsum(chosen, out=total[1:])
    return total[edges]


def cut(data: np.ndarray, edges: np.ndarray) -> tuple[pa.BinaryArray, pa.BinaryArray, np.ndarray]:
    """Letters in lower case and marks of all words as PLAIN cuts them, and which words are plain; others are left empty."""
    inside = np.ones(len(data), bool)  # not the first byte of a word
    inside[edges[:-1][edges[:-1] < len(data)]] = False
    after = inside & FOLLOWING[data]  # follows a lead
    after[1:] &= data[:-1] == LEAD
    letter, mark = LETTER[data] | after, MARK[data]
    letter[:-1] |= after[1:]
    bad = ~(letter | mark)
    bad[1:] |= inside[1:] & letter[1:] & mark[:-1]
    bad_upto = upto(bad, edges)
    plain = bad_upto[1:] == bad_upto[:-1]
    own = np.repeat(plain, np.diff(edges))
    small = np.where(after, LOWER_FOLLOWING[data], LOWER[data])

    def only(chosen: np.ndarray) -> pa.BinaryArray:
        return pa.Array.from_buffers(pa.binary(), len(plain), [
            None, pa.py_buffer(upto(chosen, edges)), pa.py_buffer(small[chosen])])

    return only(letter & own), only(mark & own), plain


class WordEncoder:
    """Packed token ids of words; plain words go straight to the tokenizer's model, which is several times faster."""

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.bare = Tokenizer(self.model)  # no normaliser, no splitter but line ends
        self.bare.pre_tokenizer = CharDelimiterSplit("\n")
        suffix = self.model.end_of_word_suffix or "\n"
        tokens = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.closing = np.array([(token or "").endswith(suffix) for token in tokens])
        self.parts = Remembered(self._part, KNOWN_PARTS)
        self.column = RememberedColumn(KNOWN_COLUMN)
        self.words = Remembered(self.word, known_words)

    def _part(self, text: str) -> bytes:
        """Ids of a piece of text that the tokenizer would not split further."""
        spelled = text if text.isascii() else text.encode().decode("latin-1").translate(ALPHABET)
        return packed([t.id for t in self.model.tokenize(spelled)])

    def word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if match := PLAIN.match(text):
            letters, marks = match.groups()
            return (self.parts[letters.lower()] if letters else b"") + (self.parts[marks] if marks else b"")
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _parts(self, texts: Sequence[str]) -> pa.LargeBinaryArray:
        """Ids of such pieces in one call of the model. The last token of each, and no other, bears the suffix."""
        spelled = SPELLED[np.frombuffer("\n".join(texts).encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.bare.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(texts):
            return pa.array([self._part(text) for text in texts], pa.large_binary())
        return binary_array(ids, np.concatenate([[0], 4 * ends]))

    def _lots(self, parts: pa.BinaryArray) -> pa.LargeBinaryArray:
        """The same for many; what the model returns takes far more room than the ids."""
        texts = parts.view(pa.string())
        return pa.concat_arrays([self._parts(texts.slice(at, PARTS_AT_ONCE).to_pylist())
                                 for at in range(0, len(texts) or 1, PARTS_AT_ONCE)])

    def encode_words(self, words: pa.BinaryArray) -> pa.LargeBinaryArray:
        """Packed ids of different words without ASCII white space. Each different plain part is looked up once."""
        edges = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[edges[0]:edges[-1]]
        letters, marks, plain = cut(data, edges - edges[0])
        parts = pa.concat_arrays([letters, marks]).dictionary_encode()
        different = parts.dictionary
        filled = pc.binary_length(different).to_numpy() > 0
        found = self.column.all_of(different.filter(pa.array(filled)), self._lots)
        others = words.filter(pa.array(~plain)).to_pylist()
        ids = pa.concat_arrays([pa.array([b""], pa.large_binary()), found,
                                pa.array([self.words[word] for word in others], pa.large_binary())])
        at = np.where(filled, filled.cumsum(), 0)[parts.indices.to_numpy()].reshape(2, len(words)).T.copy()
        at[~plain, 0] = 1 + len(found) + np.arange(len(others))
        return joined(ids.take(pa.array(at.ravel())), np.arange(0, 2 * len(words) + 1, 2))

    def encode_all(self, texts: Sequence[bytes]) -> Iterator[bytes]:
        """Packed ids of whole texts. Each different word is looked up once for all of them."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        words = split.flatten().dictionary_encode()
        different = words.dictionary.view(pa.binary())
        known = [self.encode_words(different.slice(at, WORDS_AT_ONCE))
                 for at in range(0, len(different) or 1, WORDS_AT_ONCE)]
        _, edges, data = joined(pa.concat_arrays(known).take(words.indices), split.offsets.to_numpy()).buffers()
        edges, view = np.frombuffer(edges, np.int64).tolist(), memoryview(data or b"")
        return (bytes(view[a:b]) for a, b in zip(edges, edges[1:]))

    def encode(self, text: bytes) -> bytes:
        """Packed ids of a whole text."""
        return next(self.encode_all([text]))


def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a worker process, so that words stay known between them."""
    return kept(("words", path), lambda: WordEncoder(path))


def split_words(texts: pa.BinaryArray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The row and the word of every place in the texts; empty words stand for ends that are white space."""
    split = pc.ascii_split_whitespace(texts.view(pa.string()))
    return np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy())), split.flatten().dictionary_encode()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))


def word_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts as Arrow arrays, which take a small part of the room of Python's objects."""
    def summed(pending: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        found = pa.concat_tables(pending).group_by("word").aggregate([("n", "sum")])
        found = pa.table({"word": found["word"], "n": found["n_sum"]})
        return iter(found.to_batches(max_chunksize=BATCH_WORDS))

    pending, held = [], 0
    for part in slices(batches, TEXTS_AT_ONCE):
        counts = pc.value_counts(split_words(part.column(0))[1])
        words = counts.field("values").dictionary.take(counts.field("values").indices).view(pa.binary())
        found = pa.table({"word": words, "n": counts.field("counts")})
        pending.append(found.filter(pa.array(pc.binary_length(words).to_numpy() > 0)))
        held += pending[-1].num_rows
        if held > FLUSH:
            yield from summed(pending)
            pending, held = [], 0
    if pending:
        yield from summed(pending)


def piece_table(docs: DataFrame, text_col: str, path: str) -> DataFrame:
    """Distinct pre-tokens with their frequency in all texts and their number of pieces, stored."""
    frequencies = (docs.select(as_bytes(text_col).alias("t")).mapInArrow(word_frequencies, "word binary, n bigint")
                   .groupBy("word").agg(F.sum("n").alias("n")))

    def count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No word comes twice, so whole words need not be remembered.
        encoder = kept(("pieces", path), lambda: WordEncoder(path, 0))
        for part in slices(batches, BATCH_WORDS):
            words, n = part.columns
            ids = pc.binary_length(encoder.encode_words(words)).to_numpy()
            yield pa.RecordBatch.from_arrays([words, n, pa.array(ids // 4, pa.int64())], ["word", "n", "pieces"])

    return materialize(frequencies.mapInArrow(count_pieces, "word binary, n bigint, pieces bigint"), "pieces")


def count_known(texts: pa.BinaryArray, known: pa.BinaryArray, pieces: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray, np.ndarray]:
    """Pieces of the known words of every text; offsets, words and times of its other words."""
    rows, words = split_words(texts)
    different, index = words.dictionary.view(pa.binary()), words.indices.to_numpy()
    at = pc.index_in(different, value_set=known)
    other = at.is_null().to_numpy(zero_copy_only=False)
    each = np.where(other, 0, np.append(pieces, 0)[at.fill_null(len(pieces)).to_numpy()])
    other &= pc.binary_length(different).to_numpy() > 0
    upto = np.concatenate([[0], each[index].cumsum()])
    edges = np.searchsorted(rows, np.arange(len(texts) + 1))
    places, times = np.unique((rows * len(different) + index)[other[index]], return_counts=True)
    offsets = np.searchsorted(places, np.arange(len(texts) + 1) * len(different))
    return np.diff(upto[edges]), offsets, different.take(pa.array(places % max(1, len(different)))), times


def token_counts(docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text",
                 head_rows: int = HEAD_ROWS) -> DataFrame:
    """The ``keep`` columns of every row with ``n_bytes`` (UTF-8) and ``n_tokens`` of its text.

    ``n_tokens`` is the length of the encoding without added special tokens. ``path`` names a tokenizer file whose
    normaliser and splitter never join across white space. Frequencies of the ``head_rows`` commonest pre-tokens
    are resolved in the map task against a copy of bounded size; all others are joined by shuffle, so no count is
    left out at any vocabulary size. The text itself is never moved.

    Null or empty text has 0 bytes and 0 tokens. Rows that repeat an id or a text are each counted; null ids stay.
    Very long texts are counted whole. An empty table gives an empty table. Kept columns must not be called
    ``n_bytes`` or ``n_tokens``; other columns of the input, whatever their names, are not looked at.
    """
    spark, keep = docs.sparkSession, list(keep)
    with small_batches(spark):
        pieces = piece_table(docs, text_col, path)
    commonest = (pieces.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "word")
                 .limit(head_rows).select("word", "pieces").toArrow())
    shared = spark.sparkContext.broadcast((
        pa.concat_arrays([pa.array([], pa.binary()), *commonest["word"].cast(pa.binary()).chunks]),
        commonest["pieces"].to_numpy().astype(np.int64)))
    added = "n_bytes bigint, __tc_head bigint, __tc_words array<binary>, __tc_times array<int>"
    result = extend(docs, keep, added)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(("head", path), dict)  # the encoder of the stage before goes
        fields = list(to_arrow_schema(result))[len(keep):]
        for part in slices(batches, TEXTS_AT_ONCE):
            texts = part.column(len(keep))
            head, offsets, words, times = count_known(texts, *shared.value)
            new = [pc.binary_length(texts).cast(pa.int64()), pa.array(head, pa.int64()), *(
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, type=field.type)
                for values, field in ((words, fields[2]), (pa.array(times, pa.int32()), fields[3])))]
            yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *new], schema=pa.schema(
                [*list(part.schema)[:len(keep)], *fields]))

    counted = docs.select(*keep, as_bytes(text_col).alias("__tc_text")).mapInArrow(frequencies, result)
    # A row number is only stable once it is stored together with the row.
    with small_batches(spark):
        stored = materialize(counted.withColumn("__tc_row", F.monotonically_increasing_id()), "frequencies")
    rest = (stored.select("__tc_row", F.explode(F.arrays_zip("__tc_words", "__tc_times")).alias("w"))
            .select("__tc_row", F.col("w.__tc_words").alias("word"), F.col("w.__tc_times").alias("times")))
    tail = (rest.join(pieces.select("word", "pieces"), "word")
            .groupBy("__tc_row").agg(F.sum(F.col("times") * F.col("pieces")).alias("__tc_tail")))
    summed = stored.select(*keep, "n_bytes", "__tc_head", "__tc_row").join(tail, "__tc_row", "left")
    return summed.select(*keep, "n_bytes", (F.col("__tc_head") + F.coalesce("__tc_tail", F.lit(0))).alias("n_tokens"))
