"""Small helpers for functions that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

ROWS = 512  # rows of a result batch
LONGEST = 64  # bytes of the longest key that is remembered
ENTRY = 200   # bytes that an entry takes besides key and value

_kept: dict[tuple, object] = {}


def kept(owner: tuple, make: Callable):
    """What ``make`` gives, kept by the worker process for later tasks of the same owner; a task of another owner drops it.

    Workers are used again by the next stage, so what one stage remembers must not stay beside what the next one does.
    """
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = make()
    return _kept[owner]


class Remembered(dict):
    """Values computed by ``make`` on first use, up to ``bound`` bytes; the older half is asked before it goes.

    Keys longer than ``LONGEST`` are computed each time.
    """

    def __init__(self, make: Callable, bound: int):
        super().__init__()
        self.make, self.half, self.size, self.older = make, bound // 2, 0, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self._keep(key, value)
        return value

    def _keep(self, key, value) -> None:
        if len(key) <= LONGEST:
            self.size += len(key) + cost(value) + ENTRY
            if self.size > self.half:
                self.older = dict(self)
                self.clear()
                self.size = len(key) + cost(value) + ENTRY
            self[key] = value


class RememberedColumn:
    """Keys and their values as Arrow arrays of at most ``bound`` bytes; keys that were asked for longest ago go first.

    Keys longer than ``LONGEST`` are computed each time.
    """

    def __init__(self, bound: int):
        self.bound, self.keys, self.values = bound, pa.array([], pa.binary()), pa.array([], pa.large_binary())

    def all_of(self, keys: pa.BinaryArray, make_all: Callable[[pa.BinaryArray], pa.LargeBinaryArray]
               ) -> pa.LargeBinaryArray:
        """Values of different keys; those of unknown ones are made by one call."""
        at = pc.index_in(keys, value_set=self.keys)
        unknown = at.is_null()
        new = keys.filter(unknown)
        values = pa.concat_arrays([self.values, make_all(new)])
        at, unknown = at.fill_null(0).to_numpy(), unknown.to_numpy(zero_copy_only=False)
        at = np.where(unknown, len(self.keys) + unknown.cumsum() - 1, at)
        self._keep(pa.concat_arrays([self.keys, new]), values, at)
        return values.take(pa.array(at))

    def _keep(self, keys: pa.BinaryArray, values: pa.LargeBinaryArray, asked: np.ndarray) -> None:
        idle = np.ones(len(keys), bool)
        idle[asked] = False
        order = np.concatenate([asked, np.flatnonzero(idle)])
        long = pc.binary_length(keys).to_numpy()
        size = long + pc.binary_length(values).to_numpy() + 12  # and the offsets of both
        order = order[long[order] <= LONGEST]
        kept = pa.array(order[size[order].cumsum() <= self.bound])
        self.keys, self.values = keys.take(kept), values.take(kept)


def cost(value) -> int:
    """Bytes of a value: bytes as they are, numbers of a tuple 40 each."""
    return len(value) * (1 if isinstance(value, bytes) else 40)


def as_bytes(column: str) -> Column:
    """Text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def map_rows(df: DataFrame, schema: str | StructType, work: Callable[[Iterator[dict]], Iterator[tuple]]) -> DataFrame:
    """Run ``work`` over the rows of each partition (as dicts) and collect its tuples in bounded Arrow batches."""
    result = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = to_arrow_schema(result)

        def rows() -> Iterator[dict]:
            for batch in incoming:
                for start in range(0, batch.num_rows, ROWS):
                    yield from batch.slice(start, ROWS).to_pylist()

        pending: list[tuple] = []
        for row in work(rows()):
            pending.append(row)
            if len(pending) >= ROWS:
                yield to_batch(pending, fields)
                pending = []
        if pending:
            yield to_batch(pending, fields)

    return df.mapInArrow(batches, result)


def map_texts(df: DataFrame, keep: list[str], text_col: str, added: str,
              begin: Callable[[], Callable[[bytes], tuple]]) -> DataFrame:
    """The ``keep`` columns of every row and the ``added`` ones that the function made by ``begin`` gives for its text.

    The text is UTF-8, null is empty. ``begin`` is called once per task. Kept columns stay in Arrow as they came, and a
    text that is itself kept goes to the task only once.
    """
    result = extend(df, keep, added)
    once = text_col in keep and isinstance(df.schema[text_col].dataType, StringType)
    at = keep.index(text_col) if once else len(keep)

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, of = list(to_arrow_schema(result))[len(keep):], begin()
        for batch in incoming:
            schema = pa.schema([*list(batch.schema)[:len(keep)], *fields])
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                made = zip(*map(of, part.column(at).cast(pa.binary()).fill_null(b"").to_pylist()))
                new = [pa.array(list(c), f.type) for c, f in zip(made, fields)]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *new], schema=schema)

    return df.select(*keep, *([] if once else [as_bytes(text_col).alias("__text")])).mapInArrow(batches, result)


def extend(df: DataFrame, keep: list[str], added: str) -> StructType:
    """Schema of the ``keep`` columns of ``df``, all nullable, followed by the ``added`` ones."""
    kept = [StructField(f.name, f.dataType, True) for f in (df.schema[c] for c in keep)]
    return StructType(kept + StructType.fromDDL(added).fields)


def to_batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields)
