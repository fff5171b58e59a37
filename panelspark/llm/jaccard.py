"""N-gram Jaccard join by an R-tree over count vectors.

Documents become sets of word shingles. Equal sets are one class. Hash groups of a set's tokens are counted, the counts
are a point, and the summed minima of two points bound the overlap of two sets from above. An R-tree over the points
(each node the coordinate-wise maxima of what lies below) leaves few pairs, whose tokens are compared exactly.

Before that, two exact tests bring together what can link at all: a set with too many tokens that no other set holds
links with nothing, and linked sets share one of their rarest tokens, so only families joined by such tokens are indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize, small_batches
from .arrow import as_bytes, map_rows
from .components import components
from .sharding import running_total

WORDS = 5
PERCENT = 80
GROUPS = 256            # hash groups of tokens: coordinates of a point
FANOUT = 16
SAMPLE = 4              # one token in so many takes part in the first test
FILTER_BITS = 26        # bits of the filter that picks texts for the second reading: 8 MB at any data size
BITMAP_BYTES = 4096
BLOCK_SETS = 4_096      # sets that one tree indexes ...
BLOCK_TOKENS = 2_000_000  # ... and tokens that they hold together
VERIFY = 64             # candidates compared at a time
PASSED = 200_000
WHITE = " \t\n\x0b\f\r"
NO_ID = 2 ** 63 - 1

_seeds = np.random.default_rng(5).integers(1, 2 ** 63, 2 * WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of all words if there are fewer; none without words."""
    found = [xxhash.xxh3_64_intdigest(w) for w in text.lower().split()]
    if not found:
        return np.zeros(0, np.int64)
    hashes = np.array(found, np.uint64)
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    total = np.full(count, np.uint64(width)) * _seeds[-1]
    for at in range(width):
        total = total + hashes[at:at + count] * _seeds[at]
    total ^= total >> np.uint64(32)
    total *= _seeds[WORDS]
    total ^= total >> np.uint64(29)
    return np.unique(total.view(np.int64))


def set_hash(tokens: np.ndarray) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return (value >> 64) - 2 ** 63, (value & (2 ** 64 - 1)) - 2 ** 63


def least_overlap(a: int | np.ndarray, b: int | np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of sets of these sizes that makes a link: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """R-tree over count vectors, packed bottom-up from points that were split by their widest coordinate."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.counts, self.sizes = counts, sizes
        self.order = self._pack(np.arange(len(sizes)))
        self.levels = []  # from leaves up: coordinate-wise maxima, smallest and largest set below
        high, small, large = counts[self.order], sizes[self.order], sizes[self.order]
        while len(high) > 1 or not self.levels:
            edges = np.arange(0, len(high), FANOUT)
            high = np.maximum.reduceat(high, edges)
            small, large = np.minimum.reduceat(small, edges), np.maximum.reduceat(large, edges)
            self.levels.append((high, small, large))

    def _pack(self, rows: np.ndarray) -> np.ndarray:
        """Order of points in which neighbours are alike: halves by set size, then by the most varied coordinate."""
        done, waiting, first = [], [rows], True
        while waiting:
            part = waiting.pop()
            if len(part) <= FANOUT:
                done.append(part)
                continue
            spread = self.sizes[part] if first else self.counts[part][:, self.counts[part].var(axis=0).argmax()]
            first = len(part) > 4 * FANOUT and not first
            order = part[np.argsort(spread, kind="stable")]
            half = FANOUT * (-(-len(order) // FANOUT) // 2) or FANOUT
            waiting += [order[half:], order[:half]]
        return np.concatenate(done) if done else rows

    def search(self, row: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Points whose bound allows a link with the point ``row``, and their bounds."""
        point, size = self.counts[row], int(self.sizes[row])
        low, top = -(-percent * size // 100), size * 100 // percent
        nodes = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            high, small, large = self.levels[level]
            fits = (small[nodes] <= top) & (large[nodes] >= low)
            nodes = nodes[fits]
            bound = np.minimum(high[nodes], point).sum(axis=1, dtype=np.int64)
            nodes = nodes[bound >= least_overlap(size, np.maximum(small[nodes], low), percent)]
            below = len(self.levels[level - 1][0]) if level else len(self.order)
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            nodes = nodes[nodes < below]
        found = self.order[nodes]
        found = found[(self.sizes[found] >= low) & (self.sizes[found] <= top) & (found != row)]
        bound = np.minimum(self.counts[found], point).sum(axis=1, dtype=np.int64)
        allowed = bound >= least_overlap(size, self.sizes[found], percent)
        return found[allowed], bound[allowed]


def link_block(sets: list[np.ndarray], labels: np.ndarray, percent: int, groups: int = GROUPS) -> np.ndarray:
    """Component of every set after linking within the block; ``labels`` say which sets are joined already."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    cells = owner * groups + (flat.view(np.uint64) % np.uint64(groups)).astype(np.int64)
    counts = np.bincount(cells, minlength=len(sets) * groups).reshape(len(sets), groups).astype(np.int32)
    tree = CountTree(counts, sizes)
    root = np.unique(labels, return_inverse=True)[1]
    root = np.unique(root, return_index=True)[1][root]  # label of each set: its first set with the same label
    for row in range(len(sets)):
        found, bound = tree.search(row, percent)
        later = (found > row) & (root[found] != root[row])
        found, bound = found[later], bound[later]
        found = found[np.argsort(-bound, kind="stable")]
        while len(found):
            part, found = found[:VERIFY], found[VERIFY:]
            merged = np.concatenate([sets[i] for i in part])
            at = np.minimum(np.searchsorted(sets[row], merged), sizes[row] - 1)
            starts = np.concatenate([[0], np.cumsum(sizes[part])[:-1]])
            overlap = np.add.reduceat((sets[row][at] == merged).astype(np.int64), starts)
            linked = part[100 * overlap >= percent * (sizes[row] + sizes[part] - overlap)]
            for other in linked:
                if root[other] != root[row]:
                    a, b = sorted((root[other], root[row]))
                    root[root == b] = a
            found = found[root[found] != root[row]]
    return root


def link_groups(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Edges ``a``, ``b`` between the sets (``cls``, ``tokens``, ``label``) of each group of bounded size."""
    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("cls").sort_values("cls")
        names = frame["cls"].to_numpy()
        root = link_block([np.asarray(t, np.int64) for t in frame["tokens"]], frame["label"].to_numpy(), percent)
        joined = names[root] != names
        return pd.DataFrame({"a": names[joined], "b": names[root][joined]})

    return (rows.select(*keys, "cls", "tokens", "label").groupBy(*keys)
            .applyInPandas(link, "a bigint, b bigint"))


def text_filter(hashes: DataFrame) -> dict[int, bytes]:
    """Filter of fixed size over the column ``th``; it may err only towards "contained"."""
    place = F.pmod(F.col("th"), F.lit(2 ** FILTER_BITS))
    rows = (hashes.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("at"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).toArrow().to_pylist())
    return {r["bucket"]: r["bits"] for r in rows}


def contains(bitmaps: dict[int, bytes], value: int) -> bool:
    place = value % 2 ** FILTER_BITS
    bucket, at = (1 + (place - 1) // (8 * BITMAP_BYTES), (place - 1) % (8 * BITMAP_BYTES)) if place else (0, 0)
    bits = bitmaps.get(bucket)
    return bits is not None and bits[at >> 3] >> (at & 7) & 1 == 1


def candidate_sets(texts: DataFrame, listed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Classes that may link with another one: ``cls``, ``n``, ``d1``, ``d2``, ``least_id``, ``tokens``; stored.

    A token of A that no other class holds is missing from every partner, and a partner may miss at most
    (100 - percent) % of A. Counting such tokens in a part of the hash range can only let more classes pass.
    """
    alone = (listed.select("d1", F.explode("sample").alias("token")).groupBy("token")
             .agg(F.min("d1").alias("d1"), F.max("d1").alias("other")).where("d1 = other")
             .groupBy("d1").agg(F.count(F.lit(1)).alias("alone")))
    missing = F.coalesce("alone", F.lit(0))
    passing = materialize(
        classes.where("n > 0").join(alone, "d1", "left").where(missing * 100 <= (100 - percent) * F.col("n"))
        .select("n", "d1", "d2", "least_id", "th"), "passing")
    shared = texts.sparkSession.sparkContext.broadcast(text_filter(passing.select("th")))

    def read_again(rows: Iterator[dict]) -> Iterator[tuple]:
        bitmaps, passed = shared.value, set()
        for row in rows:
            if row["th"] not in passed and contains(bitmaps, row["th"]):
                tokens = shingles(row["text"])
                yield *set_hash(tokens), tokens
                passed.add(row["th"])
                if len(passed) > PASSED:
                    passed = set()

    again = map_rows(texts, "d1 bigint, d2 bigint, tokens array<bigint>", read_again)
    single = again.join(passing.select("d1", "d2"), ["d1", "d2"], "left_semi").groupBy("d1", "d2").agg(
        F.first("tokens").alias("tokens"))
    # A number is only stable once it is stored together with the row.
    with small_batches(texts.sparkSession):
        return materialize(single.join(passing.drop("th"), ["d1", "d2"])
                           .withColumn("cls", F.monotonically_increasing_id()), "sets")


def families(sets: DataFrame, percent: int) -> DataFrame:
    """``cls`` and ``family`` of sets that share one of their rarest tokens, directly or through others.

    Linked sets share a token among the first n - ceil(percent n) + 1 of either set in any order common to all sets;
    here rarest first. Tokens that only one set holds fill places in that order but join nothing.
    """
    tokens = sets.select("cls", "n", F.explode("tokens").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    kept = tokens.join(often, "token")
    own = Window.partitionBy("cls")
    places = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("common"))
    first = (kept.withColumns({"common": F.count(F.lit(1)).over(own),
                               "at": F.row_number().over(own.orderBy("held", "token"))})
             .where(F.col("at") <= places).select("cls", "token"))
    first = materialize(first, "rarest")
    hubs = first.groupBy("token").agg(F.min("cls").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = first.join(hubs, "token").select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct()
    return components(edges).select(F.col("node").alias("cls"), F.col("root").alias("family"))


def link_sets(sets: DataFrame, percent: int, block_sets: int = BLOCK_SETS, block_tokens: int = BLOCK_TOKENS
              ) -> DataFrame:
    """``node`` and ``root`` of all sets that link with another one, directly or through others.

    Families that fit a block are linked in one go, several of them in one block. A larger family is first linked
    in two different random divisions, which joins what hangs together; then its sets are laid out by component and
    size, cut into leaves, and every pair of leaves is linked, except pairs that lie in one and the same component,
    whose sizes are too far apart, or whose summed coordinate minima are too small.
    """
    grouped = materialize(sets.join(families(sets, percent), "cls").select("cls", "n", "tokens", "family"), "families")
    weights = grouped.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t"))
    parts = F.greatest(F.ceil(F.col("m") / block_sets), F.ceil(F.col("t") / block_tokens))
    weights = materialize(weights.withColumn("parts", parts), "weights")
    fitting = weights.where("parts = 1")
    totals = fitting.agg(F.sum("m"), F.sum("t")).first()
    blocks = max(1, -(-2 * (totals[0] or 0) // block_sets), -(-2 * (totals[1] or 0) // block_tokens))
    unlabelled = F.col("cls").alias("label")
    small = (grouped.join(fitting.select("family"), "family")
             .withColumn("block", F.pmod(F.xxhash64("family"), F.lit(blocks))).select("block", "cls", "tokens", unlabelled))
    edges = materialize(link_groups(small, ["block"], percent), "links")
    large = weights.where("parts > 1").select("family", "parts")
    if not large.isEmpty():
        edges = materialize(edges.unionByName(link_large(
            materialize(grouped.join(large, "family"), "large"), percent, block_sets, block_tokens)), "links")
    return components(edges)


def link_large(sets: DataFrame, percent: int, block_sets: int, block_tokens: int) -> DataFrame:
    """Edges within families that are too large for one block."""
    edges = None
    for division in (1, 2):
        divided = sets.select(
            "family", F.pmod(F.xxhash64(F.lit(division), "cls"), 2 * F.col("parts")).alias("part"), "cls", "tokens",
            F.col("cls").alias("label"))
        found = link_groups(divided, ["family", "part"], percent)
        edges = found if edges is None else edges.unionByName(found)
    edges = materialize(edges, "links")
    roots = components(edges).toDF("cls", "root")
    labelled = (sets.join(roots, "cls", "left").withColumn("label", F.coalesce("root", "cls"))
                .withColumn("counts", count_vector(F.col("tokens"))))
    # Places count both sets and tokens, so that a leaf is bounded in either.
    room = F.lit(1.0) / (block_sets // 2) + F.col("n") / F.lit(block_tokens / 2)
    narrow = labelled.select("family", "label", "n", "cls", room.alias("room"))
    places = running_total(narrow, ["family", "label", "n", "cls"], "room", "leaves")
    leaf = F.floor("__before").cast("bigint").alias("leaf")
    placed = materialize(labelled.join(places.select("cls", leaf), "cls")
                         .select("family", "leaf", "cls", "label", "n", "tokens", "counts"), "leaves")
    # Leaves run through families; a leaf is judged for each family that it holds.
    boxes = materialize(placed.groupBy("family", "leaf").agg(
        F.min("label").alias("first"), F.max("label").alias("last"), F.min("n").alias("small"),
        F.max("n").alias("large"), *[F.max(F.get("counts", F.lit(g))).alias(f"g{g}") for g in range(LEAF_GROUPS)])
        .select("family", "leaf", "first", "last", "small", "large",
                F.array(*[f"g{g}" for g in range(LEAF_GROUPS)]).alias("high")), "boxes")
    other = boxes.select("family", *[F.col(c).alias(c + "2") for c in boxes.columns if c != "family"])
    pure = (F.col("first") == F.col("last")) & (F.col("first2") == F.col("last2")) & (F.col("first") == F.col("first2"))
    sized = ((F.col("large") * 100 >= percent * F.col("small2")) & (F.col("large2") * 100 >= percent * F.col("small")))
    bound = F.aggregate(F.zip_with("high", "high2", lambda x, y: F.least(x, y)), F.lit(0).cast("bigint"), lambda s, x: s + x)
    enough = bound * (100 + percent) >= percent * (F.col("small") + F.col("small2"))
    pairs = boxes.join(other, "family").where((F.col("leaf") <= F.col("leaf2")) & ~pure & sized & enough)
    pairs = materialize(pairs.select("family", "leaf", "leaf2"), "pairs")
    sides = pairs.select("family", "leaf", "leaf2", F.explode(F.array_distinct(F.array("leaf", "leaf2"))).alias("side"))
    members = placed.select("family", F.col("leaf").alias("side"), "cls", "tokens", "label")
    across = link_groups(sides.join(members, ["family", "side"]), ["family", "leaf", "leaf2"], percent)
    return edges.unionByName(across)


LEAF_GROUPS = 32  # coordinates of the boxes of leaves


def count_vector(tokens: Column) -> Column:
    """Counts of tokens in LEAF_GROUPS hash groups."""
    group = F.transform(tokens, lambda t: F.pmod(t, F.lit(LEAF_GROUPS)))
    return F.transform(F.sequence(F.lit(0), F.lit(LEAF_GROUPS - 1)),
                       lambda g: F.size(F.filter(group, lambda x: x == g)))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                       block_sets: int = BLOCK_SETS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per row of ``docs``: the id, ``n_shingles``, and ``component_id``, the smallest id reachable by links.

    Two more columns help to pick rows: ``component_key`` tells components apart even where ids repeat (null for
    empty sets), ``text_hash`` is the xxhash64 of the text.

    A-Z is lower-cased, words are runs without ASCII white space, a set holds the distinct 5-word shingles, or the
    whole sequence of a shorter text. Rows link if the overlap of their sets is at least ``percent`` % of the union.

    Null, empty or wordless text has an empty set, links with nothing, and is its own component. Rows with equal
    sets always link. Rows that repeat an id are compared each by itself. Rows with a null id take part; they get the
    smallest known id of their component, null if it has none. Whole texts are read, however long. An empty table
    gives an empty table. Other input columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), as_bytes(text_col).alias("text"))

    def read(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            tokens = shingles(row["text"])
            yield row["id"], row["th"], len(tokens), *set_hash(tokens), tokens[tokens % SAMPLE == 0]

    schema = "id bigint, th bigint, n bigint, d1 bigint, d2 bigint, sample array<bigint>"
    with small_batches(docs.sparkSession):
        listed = materialize(map_rows(texts, schema, read), "listed")
    classes = materialize(listed.groupBy("n", "d1", "d2").agg(
        F.min("id").alias("least_id"), F.min("th").alias("th")), "classes")
    sets = candidate_sets(texts.select("th", "text"), listed, classes, percent)
    roots = link_sets(sets, percent, block_sets, block_tokens)
    joined = sets.select("cls", "d1", "d2", "least_id").join(roots.toDF("cls", "root"), "cls")
    least = joined.groupBy("root").agg(F.min("least_id").alias("component"), F.min("d1").alias("key"))
    linked = materialize(joined.join(least, "root").select("d1", "d2", "component", "key"), "linked")
    final = classes.where("n > 0").join(linked, ["d1", "d2"], "left").select(
        "n", "d1", "d2", F.coalesce("component", "least_id").alias("component"), F.coalesce("key", "d1").alias("key"))
    final = materialize(final, "components")
    rows = listed.select("id", "th", "n", "d1", "d2").join(final, ["n", "d1", "d2"], "left")
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.col("key").alias("component_key"), F.col("th").alias("text_hash"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
                      ) -> DataFrame:
    """``docs`` without near duplicates: of every component the row with the smallest id stays.

    A null id is larger than any other; rows that agree in id and text are one and the same, one of them stays. Rows
    with an empty set link with nothing and all stay. Columns pass through unchanged.
    """
    found = jaccard_components(docs.select(id_col, text_col), id_col, text_col, percent).where("n_shingles > 0")
    ident = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    stays = (found.groupBy("component_key").agg(F.min(F.struct(ident.alias("id"), "text_hash")).alias("s"))
             .select(F.col("s.id").alias("__jc_id"), F.col("s.text_hash").alias("__jc_th"), F.lit(True).alias("__jc_in")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    wordless = F.length(F.btrim(text, F.lit(WHITE))) == 0
    rows = docs.withColumns({"__jc_id": ident, "__jc_th": F.xxhash64(text)}).join(stays, ["__jc_id", "__jc_th"], "left")
    same = Window.partitionBy("__jc_id", "__jc_th").orderBy("__jc_id")
    first = rows.withColumn("__jc_at", F.row_number().over(same))
    return first.where(wordless | (F.col("__jc_in") & (F.col("__jc_at") == 1))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
