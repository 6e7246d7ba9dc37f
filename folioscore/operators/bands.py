"""Bands of scanlines with halo rows: how stencils are partitioned.

A page is a set of rows ``(image_id, y, px)``. A band is ``height`` consecutive scanlines of a
page; a scanline also goes, as halo, to each band that starts or ends within ``halo`` rows. All
vertical neighbours a stencil chain of total radius ``halo`` needs are then inside the band, so
the partition key is (page, band): a page of any size spreads over tasks, results are exact, and
the whole chain runs on one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

BAND_ROWS = 256
CALL_BYTES = 4 << 20        # rows of whole groups that a call gets, as far as groups allow


# ------------------------------------------------------------------ many groups at a time

def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Places where a new group begins in a table that is sorted by its keys; null keys are one group."""
    new = np.ones(table.num_rows, dtype=bool)
    if table.num_rows > 1:
        same = np.ones(table.num_rows - 1, dtype=bool)
        for k in keys:
            a, b = table[k].slice(1).combine_chunks(), table[k].slice(0, table.num_rows - 1).combine_chunks()
            equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null()))
            same &= equal.to_numpy(zero_copy_only=False)
        new[1:] = ~same
    return np.flatnonzero(new)


def per_groups(rows: DataFrame, keys: list[str], order: list[str], fn: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``fn(table, starts)`` over whole groups of rows with equal keys, many groups in one call.

    Small groups cost far more to hand over one by one than to work on. Rows are dealt out and sorted by Spark; a task
    sees them in batches, and the last group of a batch waits for the next one, so memory holds a batch and a group.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            starts = group_starts(table, keys)
            held = table.slice(int(starts[-1])).to_batches()
            calls = min(len(starts) - 1, 1 + table.nbytes // CALL_BYTES)
            for some in np.array_split(np.arange(len(starts) - 1), calls) if calls else ():
                first, end = int(starts[some[0]]), int(starts[some[-1] + 1])
                yield from fn(table.slice(first, end - first), starts[some] - first).to_batches()
        if held:
            yield from fn(pa.Table.from_batches(held), np.zeros(1, dtype=np.int64)).to_batches()
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def lines_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of an array column, one after the other, and where each row's begin (one place more than rows)."""
    lists = column.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_numpy(zero_copy_only=False), offsets - offsets[0]


def by_width(values: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, places, values of those rows as one array) for each width that rows have."""
    widths = np.diff(offsets)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        yield int(width), at, values.reshape(-1, width) if len(at) == len(widths) and width else values[
            (offsets[at][:, None] + np.arange(width)).ravel()].reshape(len(at), width)


def array_column(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32, copy=False)))


def banded(rows: DataFrame, halo: int, height: int | str = BAND_ROWS) -> DataFrame:
    """Scanlines with their band, halo copies included; ``core`` marks the original. The height may be a column."""
    first = F.expr(f"int(greatest(y - {halo}, 0) div {height})")
    last = F.expr(f"int((y + {halo}) div {height})")
    return (rows.withColumn("band", F.explode(F.sequence(first, last)))
            .withColumn("core", F.expr(f"band = int(y div {height})")))


def core_rows(df: DataFrame) -> DataFrame:
    """Drop the halo copies at the end of a chain."""
    return df.where("core").drop("band", "core")


def _order() -> Window:
    return Window.partitionBy("image_id", "band").orderBy("y")


def above(col: str, k: int) -> Column:
    """The scanline ``k`` rows up, NULL outside the page."""
    return F.lag(col, k).over(_order())


def below(col: str, k: int) -> Column:
    return F.lead(col, k).over(_order())


def with_neighbours(df: DataFrame, col: str, up: int, down: int, prefix: str = "") -> DataFrame:
    """Add columns ``{prefix}u1..`` and ``{prefix}d1..`` holding the neighbouring scanlines."""
    cols = {f"{prefix}u{k}": above(col, k) for k in range(1, up + 1)}
    cols |= {f"{prefix}d{k}": below(col, k) for k in range(1, down + 1)}
    return df.withColumns(cols)


def pixels(rows: DataFrame, col: str = "px", name: str = "v") -> DataFrame:
    """One row per pixel."""
    return rows.select("image_id", "y", F.posexplode(col).alias("x", name))
