"""4-connected components of binary pages.

1. Runs: maximal horizontal ink runs of a scanline (no shuffle).
2. Bands: the runs of one (page, band) of scanlines are joined inside a task; a band is bounded,
   so this holds no matter how large a page is.
3. Seams: components that touch across two bands form a small graph, contracted with
   alternating large-star and small-star joins, each round written to the shared folder.

A component is named by its first pixel in raster order; labels are the rank of that pixel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from folioscore.operators.bands import BAND_ROWS, by_width, lines_of, per_groups
from folioscore.session import materialize

ROOT_STRIDE = 1 << 31  # first pixel as one number, y * stride + x; both are ints, so no two pixels share one


def runs(rows: DataFrame) -> DataFrame:
    """Maximal horizontal runs ``(image_id, y, x0, x1)`` of non-zero pixels."""
    px = F.col("px")
    edge = F.filter(
        F.transform(px, lambda v, i: F.when((v > 0) & (F.coalesce(F.get(px, i - 1), F.lit(0)) == 0), i)),
        lambda i: i.isNotNull())
    last = F.filter(
        F.transform(px, lambda v, i: F.when((v > 0) & (F.coalesce(F.get(px, i + 1), F.lit(0)) == 0), i)),
        lambda i: i.isNotNull())
    return (rows.select("image_id", "y", F.explode(F.arrays_zip(edge.alias("a"), last.alias("b"))).alias("r"))
            .select("image_id", "y", F.col("r.a").alias("x0"), F.col("r.b").alias("x1")))


def _runs_of_lines(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, x0, x1) of the runs of all lines, line by line."""
    ink = values > 0
    begins, ends = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1]
    ends[:-1] &= ~ink[1:]
    borders = offsets[(offsets > 0) & (offsets < len(ink))]     # a new line always begins a new run
    begins[borders] = ink[borders]
    ends[borders - 1] = ink[borders - 1]
    at, to = np.flatnonzero(begins), np.flatnonzero(ends)
    line = np.searchsorted(offsets, at, side="right") - 1
    return line, (at - offsets[line]).astype(np.int32), (to - offsets[line]).astype(np.int32)


def _join_bands(group: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """Component root of each run inside its band: smallest run number, by pointer jumping for all bands at once."""
    width = int(x1.max()) + 2
    # positions on one line, a scanline after the other, with a scanline between bands: overlap search is a sorted lookup
    new = np.append(True, group[1:] != group[:-1])
    first_y, which = y[new].astype(np.int64), np.cumsum(new) - 1
    span = y[np.append(np.flatnonzero(new)[1:] - 1, len(y) - 1)] - first_y + 2
    base = (y - first_y[which] + (np.cumsum(span) - span)[which]) * width
    first = np.searchsorted(base + x1, base + width + x0)
    stop = np.searchsorted(base + x0, base + width + x1, side="right")
    count = np.maximum(stop - first, 0)
    up = np.repeat(np.arange(len(y)), count)
    down = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    root = np.arange(len(y))
    while True:
        low = np.minimum(root[up], root[down])
        before = root.copy()
        np.minimum.at(root, root[up], low)
        np.minimum.at(root, root[down], low)
        while not np.array_equal(root[root], root):
            root = root[root]
        if np.array_equal(before, root):
            break
    return root


def _labelled_lines(table: pa.Table, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of whole bands with the run that is the root of their component; ``line`` is their row in the table."""
    line, x0, x1 = _runs_of_lines(*lines_of(table["px"]))
    y = table["y"].to_numpy()[line]
    group = np.searchsorted(starts, line, side="right") - 1
    if len(np.unique(np.stack([group, y]), axis=1).T) < len(np.unique(line)):   # lines that come twice: their runs by place
        order = np.lexsort((x0, y, group))
        line, x0, x1, y = line[order], x0[order], x1[order], y[order]
    root = _join_bands(group, y, x0, x1) if len(line) else np.zeros(0, dtype=np.int64)
    if len(line):       # of runs that begin at one pixel the first stands for all
        new = np.append(True, (np.diff(group) != 0) | (np.diff(y) != 0) | (np.diff(x0) != 0))
        root = (np.flatnonzero(new)[np.cumsum(new) - 1])[root]
    return {"line": line, "group": group, "y": y, "x0": x0, "x1": x1, "at": root, "root": y[root].astype(np.int64) * ROOT_STRIDE + x0[root]}


def _banded_lines(rows: DataFrame, band_rows: int) -> DataFrame:
    return rows.select("image_id", "y", F.expr(f"int(y div {band_rows})").alias("band"), "px")


def label_runs(rows: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """Runs with their component: ``(image_id, y, x0, x1, root)``."""
    def run(table: pa.Table, starts: np.ndarray) -> pa.Table:
        r = _labelled_lines(table, starts)
        return pa.table({"image_id": table["image_id"].take(pa.array(r["line"])), "y": pa.array(r["y"], pa.int32()),
                         **{c: pa.array(r[c]) for c in ("x0", "x1", "root")}})

    key = rows.schema["image_id"].dataType.simpleString()
    local = materialize(per_groups(_banded_lines(rows, band_rows), ["image_id", "band"], ["y"], run,
                                   f"image_id {key}, y int, x0 int, x1 int, root long"), "runs")
    merged = contract(seams(local, band_rows))
    if merged is None:
        return local
    return (local.join(merged, "image_id root".split(), "left")
            .select("image_id", "y", "x0", "x1", F.coalesce("target", "root").alias("root")))


def _component_parts(rows: DataFrame, band_rows: int) -> tuple[DataFrame, DataFrame]:
    """Finished components ``(image_id, label, root, x, y, w, h, area)`` of pages of one band, and all components of the others without label.

    A task gives one row per component of a band; runs leave it only where they lie on the border between two bands.
    A first band that does not reach its last line is a whole page: its components are neither merged nor ranked again.
    """
    types = {"label": pa.int64(), "root": pa.int64(), "y": pa.int32(), "x0": pa.int32(), "x1": pa.int32(), "last": pa.int32(), "area": pa.int64()}

    def run(table: pa.Table, starts: np.ndarray) -> pa.Table:
        r = _labelled_lines(table, starts)
        roots, own = np.unique(r["at"], return_inverse=True)
        order = np.argsort(own, kind="stable")
        first = np.searchsorted(own[order], np.arange(len(roots)))

        def over(fn: np.ufunc, v: np.ndarray) -> np.ndarray:
            return fn.reduceat(v[order], first) if len(roots) else v[:0]
        whole = np.maximum.reduceat(table["y"].to_numpy(), starts) < band_rows - 1
        page = r["group"][roots]
        rank = np.arange(len(roots)) - np.searchsorted(page, page) + 1      # roots stand in raster order, band by band
        place = r["y"] % band_rows
        border = np.flatnonzero(((place == 0) & (r["y"] > 0)) | (place == band_rows - 1))
        stats = {"label": pa.array(rank, pa.int64(), mask=~whole[page]), "root": r["root"][roots], "y": r["y"][roots], "x0": over(np.minimum, r["x0"]),
                 "x1": over(np.maximum, r["x1"]), "last": over(np.maximum, r["y"]), "area": over(np.add, (r["x1"] - r["x0"] + 1).astype(np.int64))}
        edge = {c: r[c][border] if c in ("root", "y", "x0", "x1") else pa.nulls(len(border), t) for c, t in types.items()}
        return pa.concat_tables([pa.table({"image_id": table["image_id"].take(pa.array(r["line"][at])), **{c: pa.array(v, types[c]) for c, v in part.items()}})
                                 for at, part in ((roots, stats), (border, edge))])

    key = rows.schema["image_id"].dataType.simpleString()
    local = materialize(per_groups(_banded_lines(rows, band_rows), ["image_id", "band"], ["y"], run,
                                   f"image_id {key}, label long, root long, y int, x0 int, x1 int, last int, area long"), "parts")
    merged = contract(seams(local.where("area is null"), band_rows))
    parts = local.where("area is not null and label is null")
    if merged is not None:
        parts = parts.join(merged, ["image_id", "root"], "left").withColumn("root", F.coalesce("target", "root"))
    several = parts.groupBy("image_id", "root").agg(
        F.min("x0").alias("x"), F.min("y").alias("y"), (F.max("x1") - F.min("x0") + 1).alias("w"),
        (F.max("last") - F.min("y") + 1).alias("h"), F.sum("area").alias("area"))
    done = local.where("label is not null").select(
        "image_id", "label", "root", F.col("x0").alias("x"), "y", F.expr("x1 - x0 + 1").alias("w"), F.expr("last - y + 1").alias("h"), "area")
    return done, several


def component_table(rows: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """Bounding box and pixel count per component, keyed by its root, as ``component_stats(label_runs(rows))`` has them."""
    done, several = _component_parts(rows, band_rows)
    return done.drop("label").unionByName(several)


def numbered_components(rows: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """The component table of ``connected_components`` where no runs are asked for."""
    done, several = _component_parts(rows, band_rows)
    return done.unionByName(number_components(several, band_rows))


def seams(local: DataFrame, band_rows: int) -> DataFrame:
    """Pairs of components whose pixels meet across the border of two bands."""
    def pixels_of(last_row: bool) -> DataFrame:
        at = band_rows - 1 if last_row else 0
        side = local.where(F.col("y") % band_rows == at)
        return side.select("image_id", (F.col("y") + (1 if last_row else 0)).alias("y"),
                           F.explode(F.sequence("x0", "x1")).alias("x"), "root")
    upper, lower = pixels_of(True), pixels_of(False).withColumnRenamed("root", "other")
    return upper.join(lower, ["image_id", "y", "x"]).select(
        "image_id", F.greatest("root", "other").alias("u"), F.least("root", "other").alias("v")).distinct()


def contract(edges: DataFrame) -> DataFrame | None:
    """Map every node of the graph to the smallest node of its component; None without edges.

    Alternates large-star and small-star until the edge set is a set of stars. Minima are
    combined on the map side and joined back, so a node with very many neighbours is not
    collected anywhere.
    """
    edges = materialize(edges, "seams")
    if edges.isEmpty():
        return None
    state = None
    while True:
        edges = materialize(_star(_star(edges, large=True), large=False), "seams")
        now = edges.agg(F.count(F.lit(1)), F.sum("u"), F.sum("v"), F.bit_xor(F.xxhash64("image_id", "u", "v"))).first()
        if now == state:
            return edges.select("image_id", F.col("u").alias("root"), F.col("v").alias("target"))
        state = now


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (large) or not larger (small) neighbours of each node to its minimum."""
    near = edges.select("image_id", F.col("u").alias("node"), F.col("v").alias("n"))
    if large:
        near = near.unionByName(edges.select("image_id", F.col("v").alias("node"), F.col("u").alias("n")))
    low = near.groupBy("image_id", "node").agg(F.min("n").alias("m")).withColumn("m", F.least("m", "node"))
    linked = near.join(low, ["image_id", "node"])
    if large:
        out = linked.where("n > node").select("image_id", F.col("n").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select("image_id", F.col("n").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("image_id", F.col("node").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def component_stats(labelled: DataFrame) -> DataFrame:
    """Bounding box and pixel count per component, keyed by its root."""
    return labelled.groupBy("image_id", "root").agg(
        F.min("x0").alias("x"), F.min("y").alias("y"), (F.max("x1") - F.min("x0") + 1).alias("w"),
        (F.max("y") - F.min("y") + 1).alias("h"), F.sum(F.col("x1") - F.col("x0") + 1).alias("area"))


def number_components(stats: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """Label 1, 2, .. in raster order of the first pixel.

    Ranks are taken inside (page, band of the first pixel) and shifted by the components of the
    bands before, so a page full of specks is not ranked in one task.
    """
    at = stats.withColumn("band", F.expr(f"root div ({ROOT_STRIDE}L * {band_rows})"))
    before = Window.partitionBy("image_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    shift = at.groupBy("image_id", "band").agg(F.count(F.lit(1)).alias("n")).select(
        "image_id", "band", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    rank = F.row_number().over(Window.partitionBy("image_id", "band").orderBy("root"))
    return at.withColumn("rank", rank).join(shift, ["image_id", "band"]).select(
        "image_id", (F.col("rank") + F.col("shift")).alias("label"), "root", "x", "y", "w", "h", "area")


def connected_components(rows: DataFrame, band_rows: int = BAND_ROWS) -> tuple[DataFrame, DataFrame]:
    """Component table (with labels and roots) and labelled runs of binary scanlines."""
    labelled = label_runs(rows, band_rows)
    return number_components(component_stats(labelled), band_rows), labelled


def label_pixels(labelled: DataFrame, comp: DataFrame) -> DataFrame:
    """Labelled ink pixels ``(image_id, y, x, label)``; background pixels are left out."""
    return labelled.join(comp.select("image_id", "root", "label"), ["image_id", "root"]).select(
        "image_id", "y", F.explode(F.sequence("x0", "x1")).alias("x"), "label")


def keep_components(labelled: DataFrame, kept: DataFrame) -> DataFrame:
    """Runs of the kept components; the label image of everything else is 0."""
    return labelled.join(kept.select("image_id", "root", "label"), ["image_id", "root"])


def stability(gray: DataFrame, labelled: DataFrame, comp: DataFrame) -> DataFrame:
    """Spread over components of their largest and of their smallest gray value.

    As the published code counts: background is one component, the last label is left out, and a
    component without any non-zero gray value is skipped.
    """
    pieces = labelled.join(gray.select("image_id", "y", "px"), ["image_id", "y"]).select(
        "image_id", "root", F.slice("px", F.col("x0") + 1, F.col("x1") - F.col("x0") + 1).alias("part"))
    per_root = pieces.groupBy("image_id", "root").agg(
        F.max(F.array_max("part")).alias("hi"), F.min(F.array_min("part")).alias("lo"))
    last = comp.groupBy("image_id").agg(F.max("root").alias("last"))
    ink = per_root.join(last, "image_id").where(F.col("root") < F.col("last")).select("image_id", "hi", "lo")
    covered = labelled.groupBy("image_id", "y").agg(F.collect_list(F.struct("x0", "x1")).alias("ink"))
    open_px = F.filter(F.transform("px", lambda v, i: F.when(
        F.exists(F.col("ink"), lambda r: (i >= r["x0"]) & (i <= r["x1"])), F.lit(None)).otherwise(v)),
        lambda v: v.isNotNull())
    paper = gray.join(covered, ["image_id", "y"], "left").join(last.select("image_id"), "image_id", "left_semi")
    paper = paper.withColumn("ink", F.coalesce("ink", F.array().cast("array<struct<x0:int,x1:int>>"))).select(
        "image_id", open_px.alias("part")).groupBy("image_id").agg(
        F.max(F.array_max("part")).alias("hi"), F.min(F.array_min("part")).alias("lo")).where("hi is not null")
    spread = ink.unionByName(paper).where("hi > 0").groupBy("image_id").agg(
        F.stddev_pop("hi").alias("a"), F.stddev_pop("lo").alias("b"))
    return gray.select("image_id").distinct().join(spread, "image_id", "left").select(
        "image_id", F.coalesce("a", F.lit(0.0)).alias("stability_1"),
        F.coalesce("b", F.lit(0.0)).alias("stability_2"))


def _pieces(lines: np.ndarray, y: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """(group, x, y0, y1) of the vertical runs of each band and column.

    Ink pixels of a column whose place in it and line number differ by the same are one run.
    """
    ink = lines.T > 0
    x, line = np.nonzero(ink)           # column by column, then line by line
    key = x.astype(np.int64) * (int(group[-1]) + 1) + group[line]
    new = np.append(True, key[1:] != key[:-1])
    place = np.arange(len(key)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    island = y[line].astype(np.int64) - place
    if (np.diff(y)[np.diff(group) == 0] <= 0).any():        # lines that come twice: islands need not be neighbours
        order = np.lexsort((island, key))
        x, line, key, island = x[order], line[order], key[order], island[order]
        new = np.append(True, key[1:] != key[:-1])
    first = np.flatnonzero(new | np.append(True, island[1:] != island[:-1]))
    at = y[line].astype(np.int32)
    return group[line[first]], x[first].astype(np.int32), np.minimum.reduceat(at, first), np.maximum.reduceat(at, first)


def vertical_runs(rows: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """Lengths of maximal vertical ink runs, counted: ``(image_id, length, n)``.

    Runs are found and counted inside (page, band); only the pieces that meet the border of two bands are
    stitched along the column afterwards.
    """
    def run(table: pa.Table, starts: np.ndarray) -> pa.Table:
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
        y, found = table["y"].to_numpy(), []
        for _, at, lines in by_width(*lines_of(table["px"])):
            if (lines > 0).any():
                found.append(_pieces(lines, y[at], group[at]))
        if not found:
            found = [(np.zeros(0, np.int64), *[np.zeros(0, np.int32)] * 3)]
        g, x, y0, y1 = (np.concatenate(c) for c in zip(*found))
        twice = np.zeros(len(starts), dtype=bool)       # pages with lines that come twice: pieces of the first line meet there
        twice[group[1:][(np.diff(table["y"].to_numpy()) == 0) & (np.diff(group) == 0)]] = True
        border = (((y0 > 0) | twice[g]) & (y0 % band_rows == 0)) | (y1 % band_rows == band_rows - 1)
        counted, n = np.unique(np.stack([g[~border], (y1 - y0 + 1)[~border]]), axis=1, return_counts=True)
        empty = pa.nulls(len(n), pa.int32())
        ids = table["image_id"].take(pa.array(starts))
        return pa.concat_tables([
            pa.table({"image_id": ids.take(pa.array(counted[0])), "length": pa.array(counted[1], pa.int32()), "n": pa.array(n, pa.int64()),
                      "x": empty, "y0": empty, "y1": empty}),
            pa.table({"image_id": ids.take(pa.array(g[border])), "length": pa.nulls(int(border.sum()), pa.int32()),
                      "n": pa.nulls(int(border.sum()), pa.int64()), "x": pa.array(x[border]), "y0": pa.array(y0[border]), "y1": pa.array(y1[border])})])

    key = rows.schema["image_id"].dataType.simpleString()
    pieces = materialize(per_groups(_banded_lines(rows, band_rows), ["image_id", "band"], ["y"], run,
                                    f"image_id {key}, length int, n long, x int, y0 int, y1 int"), "pieces")
    column = Window.partitionBy("image_id", "x").orderBy("y0")
    starts = F.when(F.lag("y1").over(column) + 1 == F.col("y0"), F.lit(0)).otherwise(F.lit(1))
    stitched = pieces.where("n is null").withColumn("first", starts).withColumn(
        "chain", F.sum("first").over(column)).groupBy("image_id", "x", "chain").agg(
        (F.max("y1") - F.min("y0") + 1).alias("length")).select("image_id", "length", F.lit(1).cast("long").alias("n"))
    inner = pieces.where("n is not null").select("image_id", "length", "n")
    return inner.unionByName(stitched).groupBy("image_id", "length").agg(F.sum("n").alias("n"))


def stroke_thickness(rows: DataFrame) -> DataFrame:
    """Most frequent vertical run length per page, the smallest on ties."""
    best = F.max(F.struct("n", (-F.col("length")).alias("s")))
    return vertical_runs(rows).groupBy("image_id").agg(best.alias("m")).select(
        "image_id", (-F.col("m.s")).alias("stroke_thickness"))
