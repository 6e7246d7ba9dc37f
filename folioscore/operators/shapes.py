"""Features of component tables.

All of them depend on a component only through its height, width and area. Components are
therefore first counted per (page, h, w, area), which spreads a huge page over many keys and
combines on the map side; what follows works on that much smaller shape table, with weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioscore import schema as S
from folioscore.functions import count_where, eps_ratio, weighted_sd


def _h() -> Column:
    return F.col("h")


def _w() -> Column:
    return F.col("w")


def _area() -> Column:
    return F.col("area")


def _n() -> Column:
    return F.col("n")


def _fs() -> Column:
    return F.col("fs")


def is_character(min_height=S.CHAR_MIN_HEIGHT, max_height=S.CHAR_MAX_HEIGHT,
                 min_width=S.CHAR_MIN_WIDTH, max_width=S.CHAR_MAX_WIDTH) -> Column:
    """Character-sized component, all limits inclusive."""
    return (_h().between(min_height, max_height) & _w().between(min_width, max_width)
            & (_area() >= min_height * min_width))


def filter_characters(comp: DataFrame, **limits: int) -> DataFrame:
    return comp.where(is_character(**limits))


def shape_table(comp: DataFrame) -> DataFrame:
    """Components counted per page and shape, with the lowest label of each shape."""
    return comp.groupBy("image_id", "h", "w", "area").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("first_label"))


def font_size(shapes: DataFrame, **limits: int) -> DataFrame:
    """Most frequent character height per page; the height met first (lowest label) wins ties."""
    heights = shapes.where(is_character(**limits)).groupBy("image_id", "h").agg(
        F.sum("n").alias("n"), F.min("first_label").alias("first_label"))
    best = F.max_by("h", F.struct("n", (-F.col("first_label")).alias("a"), (-_h()).alias("b")))
    return heights.groupBy("image_id").agg(best.alias("fs"))


def font_size_median(shapes: DataFrame, **limits: int) -> DataFrame:
    """Median character height per page (the weighted exact percentile)."""
    return shapes.where(is_character(**limits)).groupBy("image_id").agg(
        F.percentile("h", 0.5, _n()).alias("fs"))


def with_font_size(shapes: DataFrame, fs: DataFrame) -> DataFrame:
    """Back-join of one scalar per page; pages without characters get 0."""
    return shapes.join(fs, "image_id", "left").withColumn("fs", F.coalesce("fs", F.lit(0)))


def count(cond: Column) -> Column:
    return count_where(cond, _n())


# numerators and denominators, shared by the guarded and the plain forms -----------------

def speckle_parts(min_area: int = 5) -> tuple[Column, Column]:
    return (count((_area() >= min_area) & (_area() < _fs())), count((_area() >= min_area) & (_area() < _fs() * _fs())))


def touching_parts() -> tuple[Column, Column]:
    base = (_area() > 3 * _fs()) & (_h() > 0.75 * _fs()) & (_h() < 2 * _fs())
    return count(base & (_h() / _w() < 0.75)), count(base)


def white_speckle_parts(min_size: int | Column = 3) -> tuple[Column, Column]:
    return count((_h() < min_size) & (_w() < min_size)), F.sum("n")


def small_white_parts(min_size: int = 1) -> tuple[Column, Column]:
    return (count((_area() > min_size) & (_area() < 0.02 * _fs() * _fs())),
            count((_area() > min_size) & (_area() < _fs() * _fs())))


def stroke() -> Column:
    """Stroke width of one component from its box and area."""
    s = (_w() + _h()).cast("double")
    return 0.5 * s + F.sqrt(F.greatest(0.125 * s * s - _area() / 2, F.lit(0.0)))


def stroke_stats(sample: bool) -> tuple[Column, Column]:
    s = stroke()
    n, total = F.sum("n"), F.sum(s * _n())
    return F.try_divide(total, n), weighted_sd(n, total, F.sum(s * s * _n()), sample)


def mean_height_width(chars: Column) -> Column:
    return F.try_divide(F.sum(F.when(chars, _n() * _h() / _w())), count(chars))


def distinct_small_shapes(comp_fs: DataFrame) -> DataFrame:
    """Distinct (h, w) below 0.75 fs, per fs squared."""
    small = comp_fs.where((_h() < 0.75 * _fs()) & (_w() < 0.75 * _fs())).select("image_id", "fs", "h", "w").distinct()
    return small.groupBy("image_id", "fs").agg(F.count(F.lit(1)).alias("n")).select(
        "image_id", F.try_divide(_n(), _fs() * _fs()).alias("broken_character_factor"))


def component_bundle(comp: DataFrame, wcc: DataFrame) -> DataFrame:
    """The nine component features per page, from one shape table per polarity."""
    ink, white = shape_table(comp), shape_table(wcc)
    fs = font_size(ink)
    chars = is_character()
    mean, sd = stroke_stats(sample=True)
    ink_part = with_font_size(ink, fs).groupBy("image_id").agg(
        F.max("fs").cast("double").alias("cc_FS"),
        eps_ratio(*speckle_parts()).alias("cc_SSF"), eps_ratio(*touching_parts()).alias("cc_TCF"),
        mean.alias("cc_SW_1"), F.coalesce(sd, F.lit(0.0)).alias("cc_SW_2"),
        F.coalesce(mean_height_width(chars), F.lit(0.0)).alias("cc_height_width_ratio"),
        eps_ratio(count(chars), F.sum("n")).alias("cc_characters_to_cc_ratio"))
    white_part = with_font_size(white, fs).groupBy("image_id").agg(
        eps_ratio(*white_speckle_parts()).alias("cc_WSF"),
        eps_ratio(*small_white_parts()).alias("cc_SWS"))
    both = ink_part.join(white_part, "image_id", "full")
    return both.select("image_id", *[F.coalesce(c, F.lit(0.0)).alias(c)
                                     for c in both.columns if c != "image_id"])


def height_histogram(chars: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width histogram of heights between the page's own minimum and maximum."""
    heights = chars.groupBy("image_id", "h").agg(F.count(F.lit(1)).alias("n"))
    edges = heights.groupBy("image_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    width = F.col("hi") - F.col("lo")
    position = F.when(width == 0, F.lit(bins // 2)).otherwise(
        F.least(F.floor(F.try_divide((_h() - F.col("lo")) * bins, width)), F.lit(bins - 1)))
    return heights.join(edges, "image_id").groupBy(
        "image_id", position.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
