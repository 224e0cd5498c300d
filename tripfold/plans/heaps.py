"""First rows of several orders from one pass: a bounded state per task, merged by group.

Spark's sort-plus-limit keeps a heap per task for one order of a whole frame. For many orders, or
groups, a window would sort every row it is offered. Here a task holds at most ``k`` rows an order
and selects from each batch in linear time; what the tasks send, ``k`` rows each, is merged by
the same selection. Nothing is sorted but the last ``k`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType


@dataclass(frozen=True)
class Order:
    """The rows that count, and (column, descending) keys over numbers and times.

    As Spark orders them: nulls come first ascending and last descending, NaN is the largest.
    """

    condition: Column
    keys: tuple[tuple[str, bool], ...]


def _ranked(values: pa.Array, descending: bool) -> list[np.ndarray]:
    """Two ascending keys for one of any direction: the class (value, null, NaN), the value."""
    null = np.asarray(pc.is_null(values))
    if pa.types.is_timestamp(values.type):
        values = values.cast(pa.int64())
    numbers = np.asarray(values.fill_null(0))
    if not np.issubdtype(numbers.dtype, np.number):
        raise TypeError(f"rows are ordered by numbers and times, not {values.type}")
    missing = np.isnan(numbers) if numbers.dtype.kind == "f" else np.zeros(len(numbers), bool)
    kind = np.where(null, 2 if descending else 0, np.where(missing, 0 if descending else 2, 1))
    numbers = np.where(kind == 1, numbers, numbers.dtype.type(0))
    return [kind, -numbers if descending else numbers]


def _keys(batch: pa.Table, keys: Sequence[tuple[str, bool]]) -> list[np.ndarray]:
    return [
        part
        for name, descending in keys
        for part in _ranked(batch[name].combine_chunks(), descending)
    ]


def first_of(keys: list[np.ndarray], k: int) -> np.ndarray:
    """Places of the ``k`` first rows, in no order: by one key after the other, ties onward."""
    left, taken = np.arange(len(keys[0])), []
    for key in keys:
        if len(left) <= k:
            break
        values = key[left]
        limit = np.partition(values, k - 1)[k - 1]
        below = left[values < limit]
        taken.append(below)
        left, k = left[values == limit], k - len(below)
    return np.concatenate([*taken, left[:k]])


def first_rows(frame: DataFrame, orders: Mapping[str, Order], k: int, *columns: str) -> DataFrame:
    """``columns`` of the first ``k`` rows of each order, with its name and the row's place."""
    if k < 1 or not orders:
        raise ValueError("at least one row of one order")
    rows = frame.select(*columns, *(o.condition.alias(f"in {name}") for name, o in orders.items()))
    shape = frame.select(*columns).schema
    state = StructType().add("sample", StringType())
    placed = StructType().add("sample", StringType()).add("place", IntegerType())
    for field in shape:
        state.add(field)
        placed.add(field)
    names, keys = list(columns), {name: order.keys for name, order in orders.items()}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[str, pa.Table] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for name, own in keys.items():
                offered = table.filter(table[f"in {name}"]).select(names)
                if name in states:
                    offered = pa.concat_tables([states[name], offered])
                if offered.num_rows:
                    states[name] = offered.take(first_of(_keys(offered, own), k))
        for name, table in states.items():
            label = pa.array([name] * table.num_rows, pa.string())
            yield from table.add_column(0, "sample", label).combine_chunks().to_batches()

    def merged(table: pa.Table) -> pa.Table:
        own = keys[table["sample"][0].as_py()]
        table = table.take(first_of(_keys(table, own), k))
        table = table.take(np.lexsort(_keys(table, own)[::-1]))
        place = pa.array(range(1, table.num_rows + 1), pa.int32())
        return table.add_column(1, "place", place)

    return rows.mapInArrow(held, state).groupBy("sample").applyInArrow(merged, placed)
