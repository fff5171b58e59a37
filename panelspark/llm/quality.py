"""Quality rules: counted base rules, then line labelling by a conditional random field decides by content share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .arrow import as_bytes, extend, kept, map_rows, map_texts
from .crf import LineCrf, fit

SAMPLE_DOCS = 1_500  # labelled documents of either quality that the line model is fitted on
LINE_WINDOW = 64     # training sequences are cut to windows of so many lines
SAMPLE_WINDOWS = 12_000  # windows of these documents that it is fitted on, drawn by hash from all of their lines
MIN_SHARE = 0.5
MIN_WORDS = 10
REPEAT_PERCENT = 20
GRAM = 5

WHITE = b" \t\n\x0b\f\r"
SYMBOLS = b"#*$%&|<>"
NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
NOT_CAPITALS = bytes(set(range(256)) - set(range(65, 91)))
NOT_SMALL = bytes(set(range(256)) - set(range(97, 123)))
NOT_DIGITS = bytes(set(range(256)) - set(range(48, 58)))
FOLLOWING = bytes(range(128, 192))  # bytes inside a code point of UTF-8

FEATURES = ["always", "short", "long", "some symbols", "many symbols", "mostly symbols", "capitals", "digits",
            "exclamations", "few distinct words", "very few distinct words", "repeats previous word",
            "equals an earlier line", "no sentence end", "joined by bars"]


def code_points(data: bytes) -> int:
    return len(data.translate(None, FOLLOWING))


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five that occur at least twice."""
    n = len(words) - GRAM + 1
    if n < 2:
        return 0
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    code = ids[:n]
    for shift in range(1, GRAM):  # number the distinct windows, one more word at a time
        code = np.unique(code * (ids.max() + 1) + ids[shift:shift + n], return_inverse=True)[1].astype(np.int64)
    often = np.bincount(code)[code] > 1
    change = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + GRAM, -1)
    return int((change.cumsum()[:-1] > 0).sum())


def line_features(line: bytes, words: list[bytes], seen: set[bytes]) -> list[bool]:
    n = len(words)
    symbols = len(line.translate(None, NOT_SYMBOLS))
    capitals, small = len(line.translate(None, NOT_CAPITALS)), len(line.translate(None, NOT_SMALL))
    distinct = len(set(words))
    again = sum(a == b for a, b in zip(words, words[1:]))
    return [True, n < 4, n > 40, symbols * 10 > n, symbols * 3 > n, symbols > n, capitals > small,
            5 * len(line.translate(None, NOT_DIGITS)) > len(line), line.count(b"!") * 4 > n, n > 9 and 2 * distinct < n,
            n > 9 and 5 * distinct < n, 5 * again > n, line in seen, words[-1][-1:] not in b".!?:;\"')",
            line.count(b" | ") * 5 > n]


def line_table(text: bytes) -> tuple[list[list[bool]], list[int], int]:
    """Feature rows and word counts of the lines that hold a word, and how many equal an earlier line."""
    features, sizes, seen, doubles = [], [], set(), 0
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            features.append(line_features(line, words, seen))
            sizes.append(len(words))
            doubles += line in seen
            seen.add(line)
    return features, sizes, doubles


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> LineCrf | None:
    """Fit the line model on at most ``sample_docs`` documents of either quality, drawn by hash of the id.

    Every line of a document carries the document's label. Rows whose crc32(id) mod 4 is 2 are left out, for testing.
    Whole documents are cut into windows of LINE_WINDOW lines, of which at most ``sample_windows`` are drawn by hash
    wherever they stand, which bounds what reaches the driver. Of the rows that repeat an id the smallest text is taken.
    None without both labels.
    """
    known = (labels.where("quality IS NOT NULL").groupBy(F.col(id_col).alias("__qr_id"))
             .agg(F.max("quality").alias("q")).where(F.crc32(F.col("__qr_id").cast("string")) % 4 != 2))
    present = known.join(docs.select(F.col(id_col).alias("__qr_id")).distinct(), "__qr_id", "left_semi")
    drawn = None
    for quality in (0, 1):
        part = present.where(F.col("q") == quality).orderBy(F.xxhash64("__qr_id"), "__qr_id").limit(sample_docs)
        drawn = part if drawn is None else drawn.unionByName(part)
    drawn = materialize(drawn, "sample")
    rows = (docs.join(drawn, F.col(id_col) == F.col("__qr_id")).groupBy("__qr_id")
            .agg(F.max("q").alias("q"), F.min(F.col(text_col)).alias("t")).select("__qr_id", "q", as_bytes("t").alias("t")))

    def windows(incoming: Iterator[dict]) -> Iterator[tuple]:
        for row in incoming:
            features = line_table(row["t"])[0]
            for at in range(0, len(features), LINE_WINDOW):
                part = np.array(features[at:at + LINE_WINDOW], dtype=np.uint8)
                yield row["__qr_id"], at, row["q"], len(part), part.tobytes()

    cut = map_rows(rows, extend(rows, ["__qr_id"], "at int, q int, n int, f binary"), windows)
    found = (cut.orderBy(F.xxhash64("__qr_id", "at"), "__qr_id", "at").limit(sample_windows)
             .select("q", "n", "f").toArrow().to_pylist())
    if len({r["q"] for r in found}) < 2:
        return None
    k = len(FEATURES)
    longest = max(r["n"] for r in found)
    features = np.zeros((len(found), longest, k))
    states, real = np.zeros((len(found), longest), np.int64), np.zeros((len(found), longest), bool)
    for at, r in enumerate(found):
        features[at, :r["n"]] = np.frombuffer(r["f"], np.uint8).reshape(r["n"], k)
        states[at, :r["n"]] = 1 - r["q"]
        real[at, :r["n"]] = True
    return fit(features, states, real)


def assess(docs: DataFrame, model: LineCrf | None, keep: Sequence[str] = ("doc_id",), text_col: str = "text",
           min_share: float = MIN_SHARE) -> DataFrame:
    """The ``keep`` columns of every row with the base counts, ``base_failed``, ``content_share`` and ``kept``.

    ``content_share`` is the share of words on lines that Viterbi decoding calls content (1 without lines or
    without a model). A row is kept if it passes the base rules and its share is at least ``min_share``.

    Null or empty text has no words, fails the base rules and is not kept. Rows that repeat an id or a text are
    judged each. Whole texts are read, however long. An empty table gives an empty table. Kept columns must not carry
    the names of added ones; other input columns are not looked at.
    """
    def begin() -> Callable[[bytes], tuple]:
        kept(("quality",), lambda: None)
        return judge

    def judge(text: bytes) -> tuple:
        words = text.split()
        features, sizes, doubles = line_table(text)
        repeats = repeated_words(words)
        failed = len(words) < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * len(words)
        share = 1.0
        if model is not None and sizes:
            content = model.viterbi(np.array(features, dtype=float)) == 0
            share = float(np.array(sizes)[content].sum() / sum(sizes))
        return (len(words), code_points(text.translate(None, WHITE)), len(text.translate(None, NOT_SYMBOLS)), doubles,
                repeats, failed, share, not failed and share >= min_share)

    added = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
             "base_failed boolean, content_share double, kept boolean")
    return map_texts(docs, list(keep), text_col, added, begin)
