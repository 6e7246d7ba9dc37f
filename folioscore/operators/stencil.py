"""Fixed-radius pixel operators over banded pages.

Morphology and gradients are scanline expressions: each step takes a banded relation and replaces the scanline column
``px``; chains share the partitioning and sort of ``bands.banded``. Filters over gray values work on a band as one array. Borders: morphology ignores outside pixels, smoothing
and gradients mirror (edge pixel not repeated), median and adaptive threshold repeat the edge.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from folioscore import schema as S
from folioscore.functions import fold_lines, row_max, row_min, saturate, shift_reflect
from folioscore.operators.bands import array_column, banded, by_width, core_rows, lines_of, per_groups, with_neighbours


def gaussian_weights(size: int, sigma: float) -> list[float]:
    """Normalised weights by distance from the centre."""
    raw = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(size // 2 + 1)]
    total = raw[0] + 2 * sum(raw[1:])
    return [w / total for w in raw]


ADAPTIVE_WEIGHTS = gaussian_weights(S.ADAPTIVE_BLOCK, 0.3 * ((S.ADAPTIVE_BLOCK - 1) / 2 - 1) + 0.8)
BLUR_WEIGHTS = gaussian_weights(3, S.GAUSS_SIGMA)


# ------------------------------------------------------------------ morphology

def _drop_neighbours(df: DataFrame, up: int, down: int) -> DataFrame:
    return df.drop(*[f"u{k}" for k in range(1, up + 1)], *[f"d{k}" for k in range(1, down + 1)], "t")


def _extreme(df: DataFrame, pick, row_fn, up: int, down: int, left: int, right: int) -> DataFrame:
    df = with_neighbours(df, "px", up, down)
    near = [f"u{k}" for k in range(1, up + 1)] + [f"d{k}" for k in range(1, down + 1)]
    vertical = fold_lines(pick, F.col("px"), *[F.coalesce(c, "px") for c in near])
    df = df.withColumn("t", vertical).withColumn("px", row_fn(F.col("t"), left, right))
    return _drop_neighbours(df, up, down)


def erode(df: DataFrame, up=1, down=1, left=1, right=1) -> DataFrame:
    """Minimum over the rectangle around each pixel."""
    return _extreme(df, F.least, row_min, up, down, left, right)


def dilate(df: DataFrame, up=1, down=1, left=1, right=1) -> DataFrame:
    return _extreme(df, F.greatest, row_max, up, down, left, right)


def erode_n(df: DataFrame, n: int, size: int = 3) -> DataFrame:
    """``n`` erosions with a size x size kernel: one rectangle. Even kernels look up and left."""
    back, fore = n * (size // 2), n * ((size - 1) // 2)
    return erode(df, back, fore, back, fore)


def dilate_n(df: DataFrame, n: int, size: int = 3) -> DataFrame:
    back, fore = n * (size // 2), n * ((size - 1) // 2)
    return dilate(df, back, fore, back, fore)


def opened(rows: DataFrame, n: int = 1, size: int = 3) -> DataFrame:
    """Rows with the opened scanline ``px`` next to the original ``src``."""
    df = banded(rows.withColumn("src", F.col("px")), 2 * n * (size // 2))
    return core_rows(dilate_n(erode_n(df, n, size), n, size))


def closed(rows: DataFrame, n: int = 1, size: int = 3) -> DataFrame:
    df = banded(rows.withColumn("src", F.col("px")), 2 * n * (size // 2))
    return core_rows(erode_n(dilate_n(df, n, size), n, size))


# ------------------------------------------------------------------ smoothing, thresholds

@dataclass(frozen=True)
class Lines:
    """For each line of an array that holds several pages: the first and the last line of its own."""
    first: np.ndarray
    last: np.ndarray


def per_band(rows: DataFrame, radius: int, fn: Callable[[np.ndarray, Lines], np.ndarray], keep: str | None = None) -> DataFrame:
    """Replace ``px`` by ``fn`` of the gray values of bands (lines by columns); ``keep`` names a column for the old ones.

    Bands of one width come together as one array, with the bounds of each. A band comes with ``radius`` lines more on
    each side where the page has them, so its own edge is the page's edge, and what ``fn`` makes of the extra lines is dropped.
    """
    names = rows.columns

    def run(table: pa.Table, starts: np.ndarray) -> pa.Table:
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
        values, offsets = lines_of(table["px"])
        made = np.zeros(len(values), dtype=np.int32)
        for width, at, lines in by_width(values, offsets):
            if width:
                own = group[at]
                begin = np.append(True, own[1:] != own[:-1])
                first = np.flatnonzero(begin)
                which = np.cumsum(begin) - 1
                out = fn(lines, Lines(first[which], (np.append(first[1:], len(own)) - 1)[which])).astype(np.int32)
                if len(at) == len(group):
                    made = out.ravel()
                else:
                    made[(offsets[at][:, None] + np.arange(width)).ravel()] = out.ravel()
        core = table["core"].combine_chunks()
        out = table.select(names).set_column(names.index("px"), "px", array_column(made, offsets))
        if keep:
            out = out.append_column(keep, table["px"])
        return out.filter(core)

    fields = rows.schema.simpleString()[len("struct<"):-1]
    schema = fields + (f",{keep}:{rows.schema['px'].dataType.simpleString()}" if keep else "")
    return per_groups(banded(rows, radius), ["image_id", "band"], ["y"], run, schema)


def _shifted(a: np.ndarray, k: int, axis: int, mode: str, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """The array moved ``k`` places both ways, borders filled by ``edge`` (repeated) or ``reflect`` (mirrored)."""
    at = np.arange(a.shape[axis])
    first, last = (lines.first, lines.last) if axis == 0 else (np.zeros_like(at), np.full_like(at, a.shape[1] - 1))
    back, on = at - k, at + k
    if mode == "edge":
        back, on = np.maximum(back, first), np.minimum(on, last)
    else:
        back, on = first + np.abs(back - first), np.where(on > last, 2 * last - on, on)
        alone = first == last
        back, on = np.where(alone, at, back), np.where(alone, at, on)
    return np.take(a, back, axis=axis), np.take(a, on, axis=axis)


def weighted(a: np.ndarray, weights: list[float], mode: str, lines: Lines) -> np.ndarray:
    """Symmetric separable filter, vertical first."""
    for axis in (0, 1):
        out = a * weights[0]
        for k, w in enumerate(weights[1:], 1):
            before, after = _shifted(a, k, axis, mode, lines)
            out = out + (before + after) * w
        a = out
    return a


def smooth3(gray: np.ndarray, weights: list[float], lines: Lines) -> np.ndarray:
    """Three-tap Gaussian in both directions, mirrored borders, rounded half up."""
    return np.floor(weighted(gray.astype(np.float64), weights, "reflect", lines) + 0.5).astype(np.int32)


def median3(gray: np.ndarray, lines: Lines) -> np.ndarray:
    """Median of the 3 x 3 neighbourhood, edges repeated.

    Columns of three are sorted first; the median of nine is then the median of (largest
    minimum, median of medians, smallest maximum) over three columns.
    """
    def sorted3(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high = np.minimum(a, b), np.maximum(a, b)
        return np.minimum(low, c), np.maximum(low, np.minimum(high, c)), np.maximum(high, c)
    up, down = _shifted(gray, 1, 0, "edge", lines)
    low, middle, high = sorted3(up, gray, down)
    sides = [(*_shifted(a, 1, 1, "edge", lines), a) for a in (low, middle, high)]
    most, among, least = sorted3(*sides[0])[2], sorted3(*sides[1])[1], sorted3(*sides[2])[0]
    return sorted3(most, among, least)[1]


def adaptive_threshold(gray: np.ndarray, inverse: bool, lines: Lines) -> np.ndarray:
    """255 where a pixel is at least C darker than its surroundings (inverse), or the opposite.

    The surroundings are the weighted mean of the square block, edges repeated, rounded half up.
    """
    mean = np.floor(weighted(gray.astype(np.float64), ADAPTIVE_WEIGHTS, "edge", lines) + 0.5)
    return np.where((gray <= mean - S.ADAPTIVE_C) == inverse, 255, 0)


def binarize(rows: DataFrame) -> DataFrame:
    """Gray scanlines to ink masks: median 3 x 3, then inverse adaptive threshold.

    The gray scanline stays as ``gray``, so no later pixel join is needed.
    """
    return per_band(rows, 1 + S.ADAPTIVE_BLOCK // 2, lambda g, at: adaptive_threshold(median3(g, at), True, at), keep="gray")


def page_mask(rows: DataFrame) -> DataFrame:
    """Gray scanlines to paper masks: Gaussian 3 x 3, then adaptive threshold."""
    return per_band(rows, 1 + S.ADAPTIVE_BLOCK // 2, lambda g, at: adaptive_threshold(smooth3(g, [0.5, 0.25], at), False, at))


def invert(v: Column) -> Column:
    return F.transform(v, lambda a: F.lit(255) - a)


# ------------------------------------------------------------------ gradients

def _mirror(near: str, far: str) -> Column:
    return F.coalesce(F.col(near), F.col(far), F.col("px"))


SOBEL = {3: ((1, 2, 1), (-1, 0, 1)), 5: ((1, 4, 6, 4, 1), (-1, -2, 0, 2, 1))}


def _mirrored_rows(r: int) -> list[Column]:
    """Rows y-r..y+r, mirrored at the page edge."""
    px = F.col("px")
    if r == 1:
        return [_mirror("u1", "d1"), px, _mirror("d1", "u1")]
    u1, u2, d1, d2 = (F.col(c) for c in ("u1", "u2", "d1", "d2"))
    far_up = F.coalesce(u2, F.when(u1.isNull(), d2).otherwise(px), px)
    far_down = F.coalesce(d2, F.when(d1.isNull(), u2).otherwise(px), px)
    return [far_up, _mirror("u1", "d1"), px, _mirror("d1", "u1"), far_down]


def _horizontal(v: Column, taps: tuple[int, ...]) -> Column:
    """Integer filter along a scanline, mirrored at the edge."""
    r = len(taps) // 2

    def mirrored(i: Column, d: int) -> Column:
        if r == 1:
            return shift_reflect(v, i, d)
        last = F.size(v) - 1
        j = F.abs(i + d)
        return F.get(v, F.least(F.when(j > last, F.abs(2 * last - j)).otherwise(j), last))

    def at(a: Column, i: Column) -> Column:
        terms = [(a if d == 0 else mirrored(i, d)) * F.lit(taps[r + d])
                 for d in range(-r, r + 1) if taps[r + d]]
        return reduce(lambda p, q: p + q, terms)
    return F.transform(v, at)


def sobel(rows: DataFrame, size: int = 3) -> DataFrame:
    """Saturated absolute gradients ``gx`` and ``gy`` per scanline."""
    smooth, diff = SOBEL[size]
    r = size // 2
    df = with_neighbours(banded(rows, r), "px", r, r)
    lines = _mirrored_rows(r)

    def vertical(taps: tuple[int, ...]) -> Column:
        scaled = [F.transform(line, lambda a: a * F.lit(k)) for line, k in zip(lines, taps) if k]
        return fold_lines(lambda a, b: a + b, *scaled)
    df = df.withColumns({"sv": vertical(smooth), "dv": vertical(diff)})
    df = df.withColumns({
        "gx": F.transform(_horizontal(F.col("sv"), diff), saturate),
        "gy": F.transform(_horizontal(F.col("dv"), smooth), saturate)})
    return core_rows(_drop_neighbours(df, r, r).drop("sv", "dv"))
