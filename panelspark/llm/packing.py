"""Best-fit packing by swap-based local search.

Documents become pieces of at most ``limit`` tokens. Pieces are dealt to groups of bounded size; each group is packed
best fit first, then a local search moves pieces, swaps one for one and two for one between underfull bins, always
raising the squared fill of the fuller bin, until bins run empty or nothing improves.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .arrow import as_bytes, extend, map_rows
from .token_counts import packed, word_encoder

LIMIT = 2048
GROUP_ROWS = 16_384  # pieces that one task packs together
PORTION = 2 << 20  # bytes of texts that are encoded at a time, at least one text


def pieces_of(docs: DataFrame, path: str, keep: Sequence[str], text_col: str, limit: int, end_id: int,
              with_ids: bool) -> DataFrame:
    """One row per piece: kept columns, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    keep = list(keep)

    def cut(rows: Iterator[dict]) -> Iterator[tuple]:
        encoder, end = word_encoder(path), packed([end_id])
        for portion in portions(rows):
            for row, ids in zip(portion, encoder.encode_all([row["__bp_text"] for row in portion])):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    out = (*(row[c] for c in keep), piece, at // 4, len(part) // 4, zlib.crc32(part))
                    yield (*out, part) if with_ids else out

    added = "piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    return map_rows(docs.select(*keep, as_bytes(text_col).alias("__bp_text")), extend(docs, keep, added), cut)


def portions(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Rows in lists that end with the row that brings their texts to ``PORTION`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["__bp_text"])
        if size >= PORTION:
            yield held
            held, size = [], 0
    if held:
        yield held


class Bins:
    """Bins of bounded capacity with an index of underfull bins by free room."""

    def __init__(self, limit: int):
        self.limit, self.items, self.free = limit, [], []
        self.order: list[tuple[int, int]] = []  # (free room, bin) of underfull bins, ascending

    def open(self, item: int, length: int) -> None:
        self.items.append([item])
        self.free.append(self.limit - length)
        self._list(len(self.items) - 1)

    def _list(self, b: int) -> None:
        if self.free[b] and self.items[b]:
            insort(self.order, (self.free[b], b))

    def _unlist(self, b: int) -> None:
        at = bisect_left(self.order, (self.free[b], b))
        if at < len(self.order) and self.order[at] == (self.free[b], b):
            del self.order[at]

    def change(self, b: int, gone: Sequence[int], come: Sequence[int], lengths: Sequence[int]) -> None:
        self._unlist(b)
        for i in gone:
            self.items[b].remove(i)
        self.items[b].extend(come)
        self.free[b] += sum(lengths[i] for i in gone) - sum(lengths[i] for i in come)
        self._list(b)

    def best_fit(self, length: int) -> int | None:
        at = bisect_left(self.order, (length, -1))
        return self.order[at][1] if at < len(self.order) else None


class Offers:
    """What underfull bins hand back when they take something, by its length: nothing or one item, or two items.

    ``reach`` holds for every length handed back the most that a bin can then take, -1 where no bin offers it.
    """

    def __init__(self, limit: int):
        self.reach = [np.full(limit + 1, -1, np.int64) for _ in range(2)]
        self.heaps: list[dict[int, list]] = [{}, {}]  # by length: (-free room, bin, version, lengths handed back)
        self.version: dict[int, int] = {}
        self.listed: dict[int, tuple[dict, dict]] = {}

    def put(self, b: int, free: int, sizes: Counter) -> None:
        self.version[b] = self.version.get(b, 0) + 1
        self.listed[b] = ({0: (), **{n: (n,) for n in sizes}}, pairs_of(sizes))
        for kind, ways in enumerate(self.listed[b]):
            for total, back in ways.items():
                heappush(self.heaps[kind].setdefault(total, []), (-free, b, self.version[b], back))
                self._settle(kind, total)

    def drop(self, b: int) -> None:
        self.version[b] += 1
        for kind, ways in enumerate(self.listed.pop(b)):
            for total in ways:
                self._settle(kind, total)

    def _settle(self, kind: int, total: int) -> None:
        heap = self.heaps[kind][total]
        while heap and heap[0][2] != self.version[heap[0][1]]:
            heappop(heap)
        self.reach[kind][total] = total - heap[0][0] if heap else -1

    def best(self, sizes: Counter) -> tuple[int, tuple, tuple] | None:
        """Taker, lengths that leave the giver and lengths that come back, so that the taker grows the most.

        A move, one for one, two for one or one for two; all bins are looked at by one search per kind.
        """
        pairs = pairs_of(sizes)
        most, found = 0, None
        for kind, reach in enumerate(self.reach):
            upto = np.maximum.accumulate(reach)
            for ways in ({n: (n,) for n in sizes}, pairs)[:2 - kind]:
                totals = np.fromiter(ways, np.int64, len(ways))
                back = np.searchsorted(upto, totals)  # the least that must come back
                if len(totals) and (totals - back).max() > most:
                    at = int((totals - back).argmax())
                    most = int(totals[at] - back[at])
                    _, taker, _, lengths = self.heaps[kind][int(back[at])][0]
                    found = taker, ways[int(totals[at])], lengths
        return found


def pairs_of(sizes: Counter) -> dict[int, tuple[int, int]]:
    """Sums of two items of a bin. Different lengths in a bin are few, at most the root of twice its capacity."""
    order = sorted(sizes)
    return {a + b: (a, b) for at, a in enumerate(order) for b in order[at:] if a != b or sizes[a] > 1}


def local_search(bins: Bins, lengths: Sequence[int], least: int) -> None:
    """Raise squared fill between underfull bins until ``least`` bins remain or no exchange helps.

    The emptiest bin gives to bins at least as full, the exchange that moves most first, until it is empty or finds no
    taker; then the next one gives. Every exchange makes the fuller bin fuller, so the sum of squared fills rises
    strictly and the search ends: with a round in which every underfull bin was the giver and none found a taker.
    """
    filled = sum(1 for items in bins.items if items)
    improved = True
    while improved and filled > least:
        improved = False
        offers, givers = Offers(bins.limit), []
        held = {b: Counter(lengths[i] for i in bins.items[b]) for _, b in bins.order}
        for room, b in bins.order:
            offers.put(b, room, held[b])
            heappush(givers, (-room, b))
        while givers and filled > least:
            room, giver = heappop(givers)
            if giver not in offers.listed or -room != bins.free[giver]:
                continue
            offers.drop(giver)
            while held[giver] and (found := offers.best(held[giver])):
                taker, out, back = found
                gone, come = items_of(bins.items[giver], out, lengths), items_of(bins.items[taker], back, lengths)
                offers.drop(taker)
                bins.change(giver, gone, come, lengths)
                bins.change(taker, come, gone, lengths)
                held[giver] = held[giver] - Counter(out) + Counter(back)
                held[taker] = held[taker] - Counter(back) + Counter(out)
                if bins.free[taker]:
                    offers.put(taker, bins.free[taker], held[taker])
                    heappush(givers, (-bins.free[taker], taker))
                improved = True
            filled -= not bins.items[giver]


def items_of(items: Sequence[int], wanted: Sequence[int], lengths: Sequence[int]) -> list[int]:
    """Items of a bin that have the wanted lengths."""
    out: list[int] = []
    for n in wanted:
        out.append(next(i for i in items if lengths[i] == n and i not in out))
    return out


def pack(lengths: Sequence[int], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every piece."""
    bins = Bins(limit)
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        target = bins.best_fit(lengths[item])
        if target is None:
            bins.open(item, lengths[item])
        else:
            bins.change(target, [], [item], lengths)
    local_search(bins, lengths, -(-sum(lengths) // limit))
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for at, items in enumerate(items for items in bins.items if items):
        place = 0
        for item in items:
            number[item], offset[item] = at, place
            place += lengths[item]
    return number, offset


def pack_documents(docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text",
                   limit: int = LIMIT, end_id: int = 0, group_rows: int = GROUP_ROWS, with_ids: bool = False
                   ) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``: no sequence holds more than ``limit`` tokens.

    A document is its token ids followed by ``end_id``; only documents beyond ``limit`` are cut, the last piece may
    be shorter. Pieces are dealt evenly to ceil(pieces / group_rows) groups that are packed on their own; sequence
    ids are unique over all groups, offsets in a sequence are gapless from 0.

    Null or empty text is one piece with the end id alone. Rows that repeat an id or a text are packed each; null
    ids stay. Very long texts become many pieces, of which the full ones are sequences by themselves. An empty table
    gives an empty table. Kept columns must not carry the names of added ones; other input columns are not looked at.
    """
    keep = list(keep)
    cut = pieces_of(docs, path, keep, text_col, limit, end_id, with_ids)
    stored = materialize(cut.withColumn("__bp_row", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == limit
    open_rows = stored.where(~full).count()
    groups = max(1, -(-open_rows // group_rows))

    def pack_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__bp_row")
        number, offset = pack(frame["length"].tolist(), limit)
        base = int(frame["group"].iloc[0]) << 32
        return pd.DataFrame({"__bp_row": frame["__bp_row"].to_numpy(), "sequence_id": base + number, "offset": offset})

    group = F.pmod(F.xxhash64("__bp_row"), F.lit(groups)).alias("group")
    packed = (stored.where(~full).select("__bp_row", "length", group).groupBy("group")
              .applyInPandas(pack_group, "__bp_row bigint, sequence_id bigint, offset bigint"))
    alone = stored.where(full).select("__bp_row", (-F.col("__bp_row") - 1).alias("sequence_id"),
                                      F.lit(0).cast("bigint").alias("offset"))
    return stored.join(packed.unionByName(alone), "__bp_row").drop("__bp_row")
