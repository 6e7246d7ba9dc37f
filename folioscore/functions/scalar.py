"""Scalar column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from folioscore.schema import EPS

__all__ = ["eps_ratio", "finite_or_zero", "count_where", "entropy_term", "saturate", "wrap_add",
           "half_up", "file_stem", "join_path", "scaled_height", "int_div", "unary_maps", "any_of",
           "weighted_sd"]


def eps_ratio(num: Column, den: Column) -> Column:
    """``num / (den + EPS)``: the guarded ratio most page features use."""
    return num / (den + F.lit(EPS))


def finite_or_zero(c: Column) -> Column:
    """NULL, NaN and infinities become 0."""
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def count_where(cond: Column, weight: Column | None = None) -> Column:
    """Rows (or total weight of rows) that satisfy ``cond``."""
    if weight is None:
        return F.count_if(cond)
    return F.sum(F.when(cond, weight).otherwise(F.lit(0)))


def weighted_sd(n: Column, total: Column, total_sq: Column, sample: bool) -> Column:
    """Standard deviation from a count, a sum and a sum of squares."""
    centred = F.greatest(total_sq - F.try_divide(total * total, n), F.lit(0.0))
    return F.sqrt(F.try_divide(centred, n - 1 if sample else n))


def entropy_term(p: Column) -> Column:
    return F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0))


def saturate(c: Column) -> Column:
    """Absolute value clipped to the 8-bit range."""
    return F.least(F.abs(c), F.lit(255))


def wrap_add(a: Column, b: Column) -> Column:
    """8-bit addition with wrap-around."""
    return F.pmod(a + b, F.lit(256))


def half_up(c: Column) -> Column:
    """Round half up to an integer; filters on 8-bit pixels use this rule."""
    return F.floor(c + F.lit(0.5)).cast("int")


def file_stem(path: Column) -> Column:
    """Last path segment up to its first dot."""
    return F.regexp_extract(path, r"([^/.]+)[^/]*$", 1)


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def scaled_height(h: Column, w: Column, width: int) -> Column:
    """Height after resizing to ``width`` with the aspect kept, truncated."""
    return F.floor(h * F.lit(width) / w).cast("int")


def int_div(a: Column, b: Column) -> Column:
    return F.floor(a / b).cast("int")


def unary_maps(c: Column) -> dict[str, Column]:
    """The generated features of one column; out-of-domain values are NULL."""
    return {
        "plus1": c + 1,
        "sqrt": F.when(c >= 0, F.sqrt(c)),
        "sin": F.sin(c),
        "cos": F.cos(c),
        "inv": F.try_divide(F.lit(1.0), c),
        "exp": F.exp(c),
        "log": F.when(c > 0, F.log(c)),
        "pow2": F.pow(F.lit(2.0), c),
    }


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)
