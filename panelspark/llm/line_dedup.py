"""Line dedup: drop lines that many documents repeat, keep one copy, put the rest back in place.

DataFrame functions only. Lines are exploded with their position, normalised and hashed; distinct documents are
counted per hash, and only positions travel back to the documents.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

WHITE = " \t\n\x0b\f\r"
NO_ID = -(2 ** 63)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does just that on pure ASCII and is much faster than ``translate``."""
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_key(line: Column) -> Column:
    return F.btrim(ascii_lower(line), F.lit(WHITE))


def hash_pair(value: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a value with different seeds."""
    return F.xxhash64(value), F.xxhash64(F.lit(7), value)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, plus ``n_lines`` (before) and ``n_dropped``.

    A line whose key (stripped, A-Z lower-cased) has at least ``min_chars`` code points and stands in at least
    ``min_docs`` different ids goes everywhere except in the largest of these ids.

    Null or empty text is one empty line and comes back as the empty string. Rows with a null id count together as
    one document below all others. Rows that repeat an id count as one document; each is cleaned by itself. A text
    that loses every line becomes empty. Columns called ``n_lines`` or ``n_dropped`` in the input are replaced;
    all others pass through. An empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    first, second = hash_pair(text)
    rows = docs.select(ident.alias("id"), first.alias("t1"), second.alias("t2"), F.split(text, "\n").alias("lines"))
    exploded = rows.select("id", "t1", "t2", F.posexplode("lines").alias("pos", "line"))
    keyed = exploded.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    h1, h2 = hash_pair(F.col("key"))
    lines = materialize(keyed.select("id", "t1", "t2", "pos", h1.alias("h1"), h2.alias("h2")), "lines")

    repeated = materialize(
        lines.groupBy("h1", "h2").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs).select("h1", "h2", "keeper"), "repeated")
    dropped = (lines.join(repeated, ["h1", "h2"]).where(F.col("id") < F.col("keeper"))
               .groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("gone")))
    dropped = dropped.toDF("__ld_id", "__ld_t1", "__ld_t2", "__ld_gone")

    same = (ident == F.col("__ld_id")) & (first == F.col("__ld_t1")) & (second == F.col("__ld_t2"))
    joined = docs.join(dropped, same, "left")
    count = F.size(F.split(text, "\n"))
    gone = F.col("__ld_gone")
    stay = F.array_except(F.sequence(F.lit(0), count - 1), gone)
    parts = F.split(text, "\n")
    joined = joined.withColumns({
        "n_lines": count.cast("bigint"),
        "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("bigint"),
        "__ld_parts": F.when(gone.isNotNull(), parts),
        "__ld_stay": F.when(gone.isNotNull(), stay),
    })
    kept = F.array_join(F.transform("__ld_stay", lambda p: F.get(F.col("__ld_parts"), p)), "\n")
    out = joined.withColumn(text_col, F.when(gone.isNull(), text).otherwise(kept))
    extra = [c for c in ("n_lines", "n_dropped") if c not in docs.columns]
    return out.select(*[F.col(f"`{c}`") for c in [*docs.columns, *extra]])
