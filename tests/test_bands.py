"""Operators that take many bands at a time: the same results for many pages in one batch, and far fewer calls."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioscore.operators import bands as bd, components as cc, depth, geometry as geo, pixelstats as ps, stencil as st

SCHEMA = "image_id long, y int, px array<int>"


@pytest.fixture(scope="module")
def pages(spark):
    """Pages of several widths and bands, one of them twice."""
    rng = np.random.default_rng(3)
    shapes = {1: (5, 9), 2: (40, 9), 3: (1, 30), 4: (23, 1), 5: (17, 30)}
    made = {i: np.where(rng.random(s) < 0.6, 255, 0) for i, s in shapes.items()}
    rows = [(i, y, line.tolist()) for i, px in made.items() for y, line in enumerate(px)]
    return made, spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_call_takes_many_groups(spark, pages):
    made, rows = pages

    def run(table, starts):
        return pa.table({"groups": pa.array([len(starts)], pa.int64()), "rows": pa.array([table.num_rows], pa.int64())})
    calls = bd.per_groups(rows.coalesce(1), ["image_id"], ["y"], run, "groups long, rows long").collect()
    assert sum(r["groups"] for r in calls) == len(made) and sum(r["rows"] for r in calls) == rows.count()


def test_groups_are_whole_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = spark.createDataFrame([(None if g == 4 else g, y) for g in range(5) for y in range(7)], "g int, y int")

        def run(table, starts):
            size = np.diff(np.append(starts, table.num_rows))
            return pa.table({"g": table["g"].take(pa.array(starts)), "n": pa.array(size, pa.int64())})
        found = bd.per_groups(rows, ["g"], ["y"], run, "g int, n long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["g"] is None, r["g"] or 0, r["n"]) for r in found) == [(False, g, 7) for g in range(4)] + [(True, 0, 7)]


@pytest.mark.parametrize("band_rows", [4, 256])
@pytest.mark.parametrize("twice", [False, True])
def test_component_table_equals_that_of_the_runs(pages, band_rows, twice):
    rows = pages[1].unionByName(pages[1]) if twice else pages[1]
    comp, _ = cc.connected_components(rows, band_rows)
    columns = ["image_id", "label", "root", "x", "y", "w", "h", "area"]
    assert rows_of(cc.numbered_components(rows, band_rows).select(columns)) == rows_of(comp.select(columns))
    assert rows_of(cc.component_table(rows, band_rows).select(columns[:1] + columns[2:])) == rows_of(comp.select(columns[:1] + columns[2:]))


@pytest.mark.parametrize("band_rows", [4, 256])
def test_vertical_runs_against_columns(pages, band_rows):
    made, rows = pages
    expected = {}
    for i, px in made.items():
        for column in px.T:
            for part in "".join("1" if v else "0" for v in column).split("0"):
                if part:
                    expected[i, len(part)] = expected.get((i, len(part)), 0) + 1
    found = {(r["image_id"], r["length"]): r["n"] for r in cc.vertical_runs(rows, band_rows).collect()}
    assert found == expected


def test_depth_of_pages_of_several_widths(pages):
    made, rows = pages

    def peeled(px):
        n, ink = 0, px > 0
        while ink.any() and not (px > 0).all():
            wide = np.pad(ink, 1, constant_values=True)
            ink = np.all([wide[a:a + ink.shape[0], b:b + ink.shape[1]] for a in range(3) for b in range(3)], axis=0)
            n += 1
        return n
    assert {r["image_id"]: r["n"] for r in depth.erosion_count(rows).collect()} == {i: peeled(px) for i, px in made.items()}


def test_median_of_pages_side_by_side(pages):
    made, rows = pages
    found = {(r["image_id"], r["y"]): r["px"] for r in st.per_band(rows, 1, st.median3).collect()}
    for i, px in made.items():
        wide = np.pad(px, 1, mode="edge")
        near = np.stack([wide[a:a + px.shape[0], b:b + px.shape[1]] for a in range(3) for b in range(3)])
        for y, line in enumerate(np.median(near, axis=0).astype(int).tolist()):
            assert found[i, y] == line


@pytest.mark.parametrize("band_rows", [2, 256])
def test_rotation_in_bands(pages, band_rows):
    made, rows = pages
    found = {(r["image_id"], r["y"]): r["px"] for r in geo.rotate_landscape(rows, band_rows).collect()}
    expected = {(i, y): line for i, px in made.items()
                for y, line in enumerate((np.rot90(px, -1) if px.shape[1] > px.shape[0] else px).tolist())}
    assert found == expected


def test_histogram_leaves_a_task_counted(pages):
    made, rows = pages
    partial = ps.value_counts(rows.coalesce(1))
    assert partial.count() <= 2 * len(made)     # one row per value and page, not per pixel
    assert {(r["image_id"], r["v"]): r["n"] for r in ps.value_histogram(rows).collect()} == {
        (i, v): int((px == v).sum()) for i, px in made.items() for v in (0, 255) if (px == v).any()}
    assert ps.page_entropies(partial).where(F.col("bins") == 2).count() == len(made)


@pytest.mark.parametrize("quad", [((2, 1), (27, 4), (25, 36), (0, 33)), ((28, 0), (29, 39), (3, 38), (0, 2)), ((0, 0), (29, 0), (20, 12), (5, 39))])
def test_straightened_pages_equal_pixel_by_pixel(spark, quad):
    """Every pixel is read from its four neighbours, whatever the height of bands; no task pairs scanlines."""
    px = np.random.default_rng(4).integers(0, 256, (40, 30))
    rows = spark.createDataFrame([(i, y, line.tolist()) for i in (1, 2) for y, line in enumerate(px)], SCHEMA)
    at = [dict(zip("xy", p)) for p in quad]
    quads = spark.createDataFrame([(1, *[(p["x"], p["y"]) for p in at])], "image_id long, " + ", ".join(
        f"{n} struct<x:int,y:int>" for n in ("tl", "tr", "br", "bl")))
    m = geo.homography(quads).first()
    want = np.zeros_like(px)
    for y in range(40):
        for x in range(30):
            u, v = x / 30, y / 40
            z = m["hg"] * u + m["hh"] * v + 1
            sx, sy = (m["ha"] * u + m["hb"] * v + m["hc"]) / z, (m["hd"] * u + m["he"] * v + m["hf"]) / z
            x0, y0 = int(np.floor(sx)), int(np.floor(sy))
            near = [[px[b, a] if 0 <= a < 30 and 0 <= b < 40 else 0 for a in (x0, x0 + 1)] for b in (y0, y0 + 1)]
            lines = [a * (1 - (sx - x0)) + b * (sx - x0) for a, b in near]
            want[y, x] = np.floor(lines[0] * (1 - (sy - y0)) + lines[1] * (sy - y0) + 0.5)
    both = [(1, y, line.tolist()) for y, line in enumerate(want)] + [(2, y, line.tolist()) for y, line in enumerate(px)]
    for height in (4, 256):
        assert rows_of(geo.straighten(rows, quads, height)) == both


def test_straightening_refuses_a_scanline_that_is_there_twice(spark):
    rows = spark.createDataFrame([(1, y, [y] * 8) for y in (0, 1, 2, 2, 3, 4, 5)], SCHEMA)
    point = "struct<x:int,y:int>"
    quads = spark.createDataFrame([(1, {"x": 0, "y": 0}, {"x": 7, "y": 1}, {"x": 7, "y": 5}, {"x": 0, "y": 5})],
                                  f"image_id long, tl {point}, tr {point}, br {point}, bl {point}")
    with pytest.raises(Exception, match="scanline twice"):
        geo.straighten(rows, quads).collect()
