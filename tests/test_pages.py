"""Stencils, erosion depth and components on hand-made and random pages, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscore.operators import bands as bd, components as cc, depth, packed as pk, pixelstats as ps, shapes as sh, stencil as st

RNG = np.random.default_rng(7)


def ink(text):
    return [[255 if c == "#" else 0 for c in line] for line in text.split()]


RING = ink("##### #...# #.#.# #...# #####")
SPIRAL = ink("######### ........# #######.# #.....#.# #.###.#.# #.#...#.# #.#####.# #.......# #########")
U_SHAPE = ink("#...# #...# #...# #####")
DIAGONAL = ink("##... ##... ..### ..###")
CHECKER = [[255 * ((x + y) % 2) for x in range(6)] for y in range(7)]
RANDOM = [(255 * (RNG.random((h, w)) < p)).tolist() for h, w, p in
          ((1, 1, 1), (1, 9, .6), (9, 1, .6), (13, 8, .5), (20, 11, .7), (30, 5, .85), (6, 6, 2), (5, 7, -1))]
PAGES = [RING, SPIRAL, U_SHAPE, DIAGONAL, CHECKER, *RANDOM]


def brute_components(grid):
    """(first pixel, x, y, w, h, area) by flood fill."""
    a, out = np.array(grid) > 0, []
    seen = np.zeros_like(a)
    for y, x in zip(*np.nonzero(a)):
        if seen[y, x]:
            continue
        stack, cells = [(y, x)], []
        seen[y, x] = True
        while stack:
            p, q = stack.pop()
            cells.append((p, q))
            for r, s in ((p + 1, q), (p - 1, q), (p, q + 1), (p, q - 1)):
                if 0 <= r < a.shape[0] and 0 <= s < a.shape[1] and a[r, s] and not seen[r, s]:
                    seen[r, s] = True
                    stack.append((r, s))
        ys, xs = zip(*cells)
        out.append((len(out) + 1, min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(cells)))
    return out


@pytest.mark.parametrize("band", [2, 3, 256])
def test_components_equal_flood_fill(page, band):
    comp, labelled = cc.connected_components(page(*PAGES), band)
    got = sorted(tuple(r) for r in comp.select("image_id", "label", "x", "y", "w", "h", "area").collect())
    want = sorted((i, *c) for i, g in enumerate(PAGES) for c in brute_components(g))
    assert got == want
    area = labelled.agg(F.sum(F.col("x1") - F.col("x0") + 1)).first()[0]
    assert area == sum((np.array(g) > 0).sum() for g in PAGES)


def test_ring_has_two_white_components(page):
    white = page(RING).withColumn("px", st.invert(F.col("px")))
    assert cc.connected_components(white, 2)[0].count() == 1  # the centre pixel splits nothing off
    boxed = ink("##### #...# #...# #####")
    outer = [[0] * 7, *[[0, *line, 0] for line in boxed], [0] * 7]
    white = page(outer).withColumn("px", st.invert(F.col("px")))
    assert cc.connected_components(white, 2)[0].count() == 2


def naive_depth(grid, cap=250):
    a = np.array(grid)
    for i in range(cap):
        b = np.pad(a, 1, constant_values=255)
        a = np.min([b[1 + dy:b.shape[0] - 1 + dy, 1 + dx:b.shape[1] - 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
        if a.min() == a.max():
            return i / cap
    return 1.0


def test_erosion_equals_loop(page):
    deep = np.full((1200, 3), 255)
    deep[0, 0] = 0
    solid = np.full((40, 40), 255)
    solid[:, 0] = 0
    grids = [*PAGES, deep.tolist(), solid.tolist()]
    got = {r["image_id"]: r["erosion"] for r in depth.erosion_feature(page(*grids)).collect()}
    assert got == {i: naive_depth(g) for i, g in enumerate(grids)}


def test_erosion_count_is_uncapped(page):
    tall = np.full((30, 3), 255)
    tall[0, 0] = 0
    got = depth.erosion_count(page(tall.tolist(), RING))
    assert {r["image_id"]: r["n"] for r in got.collect()} == {0: 29, 1: 1}


def test_distances_across_bands(page, monkeypatch):
    monkeypatch.setattr(depth, "BAND_ROWS", 5)
    grids = []
    for h, w, holes in ((43, 30, 1), (64, 3, 2), (17, 50, 3), (5, 5, 0), (6, 1, 1), (90, 60, 4)):
        grid = np.full((h, w), 255)
        for _ in range(holes):
            grid[RNG.integers(0, h), RNG.integers(0, w)] = 0
        grids.append(grid)
    want = {}
    for i, g in enumerate(grids):
        hole = np.argwhere(g == 0)
        y, x = np.indices(g.shape)
        far = [np.maximum(abs(y - a), abs(x - b)) for a, b in hole]
        want[i] = int(np.min(far, axis=0).max()) if far else 0
    rows = page(*[g.tolist() for g in grids])
    assert {r["image_id"]: r["n"] for r in depth.erosion_count(rows).collect()} == want
    flipped = page(*[(255 - g).tolist() for g in grids])
    got = {r["image_id"]: r["depth"] for r in depth.erosion_depth(flipped, None, inverse=True).collect()}
    assert {i: d for i, d in got.items() if i != 3} == {i: d for i, d in want.items() if i != 3}


def brute_counts(g):
    """The counts of one page, pixel by pixel."""
    g = np.array(g) > 0
    h, w = g.shape

    def near(a, dy, dx, rule):
        def at(i, n, d):
            j = i + d
            if rule == "edge":
                return min(max(j, 0), n - 1)
            return j if 0 <= j < n else i - d if 0 <= i - d < n else i
        return np.array([[a[at(y, h, dy), at(x, w, dx)] for x in range(w)] for y in range(h)])

    def square(a, fn):
        return np.array([[fn(a[max(y - 1, 0):y + 2, max(x - 1, 0):x + 2]) for x in range(w)] for y in range(h)])

    def taps(a, vertical, horizontal, rule="mirror"):
        r = len(vertical) // 2
        t = sum(k * near(a, d, 0, rule) for d, k in zip(range(-r, r + 1), vertical))
        return sum(k * near(t, 0, d, rule) for d, k in zip(range(-r, r + 1), horizontal))
    c, s = st.BLUR_WEIGHTS
    blur = np.floor(taps(g * 255.0, (s, c, s), (s, c, s)) + 0.5)
    medians = [taps(g * 1, *[[1] * (2 * r + 1)] * 2, "edge") > ((2 * r + 1) ** 2) // 2 for r in (1, 2)]
    gx, gy = taps(g * 1, (1, 2, 1), (-1, 0, 1)) != 0, taps(g * 1, (-1, 0, 1), (1, 2, 1)) != 0
    out = {"pixels": g.size, "ink": g.sum(), "closing": (square(square(g, np.max), np.min) != g).sum(),
           "opening": (square(square(g, np.min), np.max) != g).sum(), "blurred": (blur != g * 255).sum(),
           "median_1": (medians[0] != g).sum(), "median_2": (medians[1] != g).sum(), "median_ink": medians[0].sum(),
           "gradients_1": gx.sum(), "gradients_2": gy.sum(), "gradients_3": (gx != gy).sum()}
    return {k: int(v) for k, v in (out | {f"gaussian_{i}": ((blur > t) != g).sum() for i, t in enumerate((120, 150, 180, 190), 1)}).items()}


def test_packed_counts_equal_brute_force(page):
    shapes = [(1, 1), (5, 1), (1, 9), (2, 2), (3, 59), (4, 60), (4, 61), (5, 62), (3, 63), (6, 64), (6, 65), (5, 120), (4, 121), (7, 185), (270, 4)]
    grids = [(RNG.random(s) < d).astype(int) * 255 for s, d in zip(shapes, [0.2, 0.5, 0.8] * 5)]
    grids += [np.zeros((4, 70), dtype=int), np.full((4, 70), 255)]
    got = {r["image_id"]: r.asDict() for r in pk.page_counts(page(*[g.tolist() for g in grids])).collect()}
    for i, g in enumerate(grids):
        assert {k: v for k, v in got[i].items() if k != "image_id"} == brute_counts(g), shapes[i:i + 1]


def test_bands_do_not_change_stencils(page):
    gray = RNG.integers(0, 256, (23, 9)).tolist()
    rows = page(gray)

    def run(height, step):
        return sorted(tuple([r["y"], *r["px"]]) for r in bd.core_rows(step(bd.banded(rows, 6, height))).collect())
    for step in (st.erode, st.dilate):
        assert run(4, step) == run(1000, step)


def test_bands_do_not_change_filters(page, monkeypatch):
    from functools import partial
    rows = page(RNG.integers(0, 256, (23, 9)).tolist(), [[7]], RNG.integers(0, 256, (1, 5)).tolist(), RNG.integers(0, 256, (30, 1)).tolist())

    def out(df):
        return sorted((r["image_id"], r["y"], *r["px"]) for r in df.collect())
    whole = [out(st.binarize(rows)), out(st.page_mask(rows))]
    monkeypatch.setattr(st, "banded", partial(bd.banded, height=4))
    assert [out(st.binarize(rows)), out(st.page_mask(rows))] == whole
    assert st.binarize(rows).columns == ["image_id", "y", "px", "gray"]


def test_opening_below_page_below_closing(page):
    rows = page(*PAGES)
    for fn, sign in ((st.opened, 1), (st.closed, -1)):
        bad = fn(rows).select(F.exists(F.zip_with("src", "px", lambda a, b: (a - b) * sign < 0), lambda f: f).alias("bad"))
        assert bad.where("bad").count() == 0


def test_erosion_of_inverse_is_inverse_of_dilation(page):
    rows = page(*PAGES)
    inv = rows.withColumn("px", st.invert(F.col("px")))

    def out(df):
        return sorted((r["image_id"], r["y"], tuple(r["px"])) for r in df.collect())
    left = bd.core_rows(st.erode(bd.banded(inv, 1)))
    right = bd.core_rows(st.dilate(bd.banded(rows, 1))).withColumn("px", st.invert(F.col("px")))
    assert out(left) == out(right.select(left.columns))


@pytest.mark.parametrize("band", [3, 256])
def test_vertical_runs_across_bands(page, band):
    from itertools import groupby
    from collections import Counter
    want = {}
    for i, g in enumerate(PAGES):
        runs = Counter(sum(1 for _ in a) for col in np.array(g).T for v, a in groupby(col) if v > 0)
        want |= {(i, k): n for k, n in runs.items()}
    got = {(r["image_id"], r["length"]): r["n"] for r in cc.vertical_runs(page(*PAGES), band).collect()}
    assert got == want


def test_blank_page_features_are_zero(page):
    counts = pk.page_features(pk.page_counts(page([[0] * 5] * 4))).first()
    assert all(v == 0 for k, v in counts.asDict().items() if k != "image_id")


def test_constant_gray(page):
    hist = ps.value_histogram(page([[9] * 4] * 4))
    assert ps.mean_sd(hist).first()[1:] == (9.0, 0.0)
    assert all(r["entropy"] == 0 for r in ps.page_entropies(hist).collect())
    assert ps.otsu_threshold(hist).first()["t"] == 0


def components_table(spark, rows):
    return spark.createDataFrame(rows, "image_id long, label long, h int, w int, area long")


def test_mode_tie_takes_first_seen(spark):
    comp = components_table(spark, [(1, 1, 9, 5, 20), (1, 2, 9, 5, 20), (1, 3, 6, 5, 20), (1, 4, 6, 5, 20), (2, 1, 50, 50, 900)])
    shapes = sh.shape_table(comp)
    assert [tuple(r) for r in sh.font_size(shapes).collect()] == [(1, 9)]
    bundle = {r["image_id"]: r for r in sh.component_bundle(comp, comp).collect()}
    assert bundle[2]["cc_FS"] == 0 and bundle[2]["cc_SW_2"] == 0
