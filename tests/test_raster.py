"""Frames against arrays: neighbourhoods, components over tiles, regions, pipelines' invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import components, frames, kernels, neighbourhood, regions, shapes, threshold, tiles
from tessera.plans import segment
from tessera.plans.config import LargeConfig, SegmentConfig


def frame(spark, a, name="v", skip_zero=False):
    y, x = np.nonzero(a) if skip_zero else np.nonzero(np.ones(a.shape))
    return spark.createDataFrame([(int(i), int(j), int(a[i, j])) for i, j in zip(y, x, strict=True)], f"y int, x int, {name} bigint")


def array(df, size, name="v", dtype=np.int64):
    out = np.zeros(size, dtype)
    for r in df.collect():
        out[r["y"], r["x"]] = r[name] if name else 1
    return out


@pytest.fixture(scope="module")
def image():
    return np.random.default_rng(0).integers(0, 200, (14, 17))


def test_smoothing(spark, image):
    px = frame(spark, image)
    w = np.array(neighbourhood.gaussian_weights(1.3))
    r = len(w) // 2
    for edge, mode in (("reflect", "symmetric"), ("nearest", "edge"), ("constant", "constant")):
        p = np.pad(image, r, mode=mode)
        rows = np.array([[(p[y, x : x + 2 * r + 1] * w).sum() for x in range(17)] for y in range(p.shape[0])])
        want = np.array([[(rows[y : y + 2 * r + 1, x] * w).sum() for x in range(17)] for y in range(14)])
        got, scale = neighbourhood.gaussian(px, 1.3, image.shape, edge)
        assert np.array_equal(array(got, image.shape), want) and scale == w.sum() ** 2
    assert neighbourhood.gaussian(px, 0, image.shape)[0] is px


def test_maxima_erosion_boundary(spark, image):
    got = array(neighbourhood.local_maxima(frame(spark, image), image.shape), image.shape, None)
    assert np.array_equal(got > 0, kernels.window_peaks(image))
    mask = np.random.default_rng(5).random((15, 15)) > 0.2
    want = np.array([[all(0 <= y + a < 15 and 0 <= x + b < 15 and mask[y + a, x + b] for a, b in neighbourhood.disk(1)) for x in range(15)] for y in range(15)])
    assert np.array_equal(array(neighbourhood.erode(frame(spark, mask, skip_zero=True), 1), mask.shape, None) > 0, want)
    labels = np.zeros((8, 9), int)
    labels[1:4, 1:4], labels[1:4, 4:7], labels[6, 0] = 1, 2, 3
    got = array(neighbourhood.outer_boundary(frame(spark, labels, "label", True), labels.shape), labels.shape, None)
    p = np.pad(labels, 1, constant_values=-1)
    for y in range(8):
        for x in range(9):
            near = [p[y + 1 + a, x + 1 + b] for a, b in kernels.FOUR if p[y + 1 + a, x + 1 + b] >= 0]
            window = [v for v in p[y : y + 3, x : x + 3].ravel() if v > 0]
            own = labels[y, x]
            assert got[y, x] == ((not own and any(near)) or (own and any(v != own for v in near) and any(v != own for v in window)))


@pytest.mark.parametrize("tile", [4, 8, 64])
def test_components_do_not_depend_on_tiles(spark, tile):
    mask = np.random.default_rng(6).random((20, 20)) > 0.45
    px = frame(spark, mask, skip_zero=True)
    for connectivity in (1, 2):
        got = array(components.relabelled(px, 20, connectivity, tile), mask.shape, "label")
        assert np.array_equal(got, kernels.components(mask, connectivity))


def test_component_edge_cases(spark):
    assert components.label(spark.createDataFrame([], "y int, x int"), 5).count() == 0
    one = components.label(spark.createDataFrame([(3, 4)], "y int, x int"), 5).collect()
    assert [(r["y"], r["x"], r["label"]) for r in one] == [(3, 4, 19)]
    corner = spark.createDataFrame([(7, 7), (8, 8)], "y int, x int")
    assert components.label(corner, 16, 2, 8).select("label").distinct().count() == 1
    assert components.label(corner, 16, 1, 8).select("label").distinct().count() == 2


def test_distances_and_growth(spark):
    labels = np.zeros((12, 13), int)
    labels[2, 2], labels[9, 10], labels[3, 9] = 1, 2, 3
    px = frame(spark, labels, "label", True)
    assert np.array_equal(array(shapes.squared_distance(px, labels.shape), labels.shape, "d2"), kernels.squared_distances(labels > 0))
    grown = array(neighbourhood.expand_labels(px, 3, labels.shape), labels.shape, "label")
    for y in range(12):
        for x in range(13):
            best = min(((y - a) ** 2 + (x - b) ** 2, labels[a, b]) for a, b in np.argwhere(labels))
            assert grown[y, x] == (best[1] if best[0] <= 9 else 0)
    added = array(neighbourhood.difference(frame(spark, grown, "label", True), px), labels.shape, "label")
    assert np.array_equal(added, np.where(labels > 0, 0, grown))


def test_otsu(spark):
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.normal(60, 9, 300), rng.normal(160, 9, 300)]).round().astype(int)
    px = spark.createDataFrame([(int(i),) for i in v], "v bigint")
    best = max(range(v.min(), v.max()), key=lambda t: ((v <= t).sum() * (v > t).sum() * (v[v <= t].mean() - v[v > t].mean()) ** 2, -t))
    assert threshold.otsu_integers(px).first()["threshold"] == best
    assert threshold.otsu_integers(px.where("v = 60")).count() == 0 and threshold.otsu_bins(px.where("v = 60")).count() == 0


def test_resize_pyramid_windows(spark, image):
    px = frame(spark, image)
    for to in ((7, 40), (28, 5)):
        want = image[(2 * np.arange(to[0]) + 1) * 14 // (2 * to[0])][:, (2 * np.arange(to[1]) + 1) * 17 // (2 * to[1])]
        assert np.array_equal(array(frames.resize_nearest(px, image.shape, to), to), want)
    even = np.pad(image, ((0, 0), (0, 1)))
    assert np.array_equal(array(frames.mean_half(px), (7, 9)), even.reshape(7, 2, 9, 2).sum(axis=(1, 3)) // 4)
    assert np.array_equal(array(frames.stride_half(px), (7, 9)), image[::2, ::2])
    assert frames.pyramid_plan(1024, 900)[0] == 0 and frames.pyramid_plan(1025, 900)[0] == 1 and frames.pyramid_plan(8000, 3000) == (3, 1008, 384)
    assert tiles.window_plan((100, 60), 50, 10) == ((130, 90), (3, 2))
    assert frames.auto_rectangle(10, 4) == (3, 1, 3, 1)
    for tile, halo in ((4, 2), (16, 16)):
        assert np.array_equal(array(tiles.tiled_views(px, tile, halo, image.shape), image.shape), image)


def test_region_filters_and_numbers(spark):
    labels = spark.createDataFrame([(0, i, 5 * (1 + i // 3)) for i in range(12)], "y int, x int, label bigint")
    objects = regions.measure(labels, frame(spark, np.arange(12)[None]))
    got = {r["label"]: (r["area"], r["sum_intensity"], r["max_intensity"]) for r in objects.collect()}
    assert got == {5: (3, 3, 2), 10: (3, 12, 5), 15: (3, 21, 8), 20: (3, 30, 11)}
    assert objects.where(regions.area_between(2, 3)).count() == 0 and objects.where(regions.area_from(3)).count() == 4
    assert {r["label"]: r["to"] for r in regions.numbered(labels).collect()} == {5: 1, 10: 2, 15: 3, 20: 4}
    spots = spark.createDataFrame([(0, 0), (0, 1)], "y int, x int")
    assert {r["label"]: r["n_spots"] for r in regions.spots_by_object(labels, spots).collect()} == {5: 2, 10: 0, 15: 0, 20: 0}
    assert {r["label"] for r in regions.clear_border(labels.withColumn("y", F.lit(3)), (8, 12)).collect()} == {10, 15}


@pytest.fixture(scope="module")
def cells(spark):
    """Nine discs on a 60 x 60 canvas: labels, and centre and contour maps."""
    labels, center = np.zeros((60, 60), int), np.zeros((60, 60), int)
    for k in range(9):
        cy, cx = 12 + 18 * (k // 3), 12 + 18 * (k % 3)
        for y in range(60):
            for x in range(60):
                d = (y - cy) ** 2 + (x - cx) ** 2
                if d < 36:
                    labels[y, x], center[y, x] = k + 1, 255 - 4 * d - (40 if k == 4 else 0)
    rows = [(y, x, int(center[y, x]), int(255 - center[y, x])) for y in range(60) for x in range(60)]
    return labels, spark.createDataFrame(rows, "y int, x int, center int, contour int").cache()


def test_nuclei(spark, cells):
    labels, pmap = cells
    image = pmap.select("y", "x", F.col("center").alias("v"))
    tissue = frame(spark, labels, "label", True)
    found = segment.nuclei(pmap, image, tissue, (60, 60), SegmentConfig(log_sigma=(3, 30), nuclei_filter="none"), 30, 12)
    got = array(found, (60, 60), "label")
    assert set(np.unique(got)) == set(range(10))
    assert np.array_equal(got > 0, labels > 0) and len({(a, b) for a, b in zip(got.ravel(), labels.ravel(), strict=True)}) == 10
    dim = segment.nuclei(pmap, image, tissue, (60, 60), SegmentConfig(log_sigma=(3, 30)), 60, 0)
    assert dim.select("label").distinct().count() < 9  # the mean-intensity threshold drops some
    bypass = segment.nuclei_bypass(frame(spark, labels, "label", True), (60, 60), SegmentConfig(log_sigma=(3, 30)))
    assert np.array_equal(array(bypass, (60, 60), "label"), kernels.components(labels > 0, 1))


@pytest.mark.parametrize("method", ["ring", "distanceTransform", "hybrid"])
def test_cells(spark, cells, method):
    labels, pmap = cells
    nuclei = frame(spark, labels, "label", True)
    image = pmap.select("y", "x", F.col("center").alias("v"))
    tissue = segment.plate_mask((60, 60), nuclei) if method == "distanceTransform" else nuclei.select("y", "x")
    out = segment.cytoplasm(nuclei, image, tissue, (60, 60), SegmentConfig(cyto_dilation=3), method, 60, 0)
    cell, core, cyto = (array(d, (60, 60), "label") for d in (out.cell, out.nuclei, out.cyto))
    assert np.array_equal(cell, core + cyto) and not (core * cyto).any()
    ids = np.unique(cell[cell > 0])
    assert ids.tolist() == list(range(1, len(ids) + 1)) and len(ids) >= 1
    assert all((core == k).any() for k in ids)
    assert not any(edge.any() for edge in (cell[0], cell[-1], cell[:, 0], cell[:, -1]))
    if method == "ring":
        assert not (cell > 0)[kernels.squared_distances(labels > 0) > 9].any()


def test_large_chain(spark, cells):
    labels, pmap = cells
    chain = segment.LargeSegmentor(pmap, (60, 60), LargeConfig(overlap_size=16, mean_intensity_min=5, area_max=5000, expand_size=2), 30)
    found = chain.run()
    got = array(found, (60, 60), "label")
    ids = np.unique(got[got > 0])
    assert ids.tolist() == list(range(1, len(ids) + 1)) and len(ids) >= 9
    grown, added = chain.expanded(found)
    g, a = array(grown, (60, 60), "label"), array(added, (60, 60), "label")
    assert np.array_equal(g, np.where(got > 0, got, a))


def test_puncta_and_areas(spark):
    image = np.zeros((30, 30), int)
    rng = np.random.default_rng(1)
    image += rng.integers(0, 6, image.shape)
    for y, x in ((5, 5), (15, 20), (25, 9)):
        image[y, x] += 120
    px = frame(spark, image)
    found = segment.puncta(px, px, 1.0, 4.0, image.shape)
    assert {(r["y"], r["x"]) for r in found.collect()} >= {(5, 5), (15, 20), (25, 9)} and found.count() < 12
    stack = frames.stack(px, px)
    areas = {r["c"]: r["area"] for r in segment.pixel_areas(px, stack, px.select("y", "x"), image.shape, limit=50).collect()}
    assert areas[-1] == (image > 0.8 * image.max()).sum() and set(areas) == {-1, 0, 1}


def test_distances_and_medians(spark):
    rng = np.random.default_rng(8)
    mask = np.zeros((150, 90), bool)
    mask[rng.integers(0, 150, 40), rng.integers(0, 90, 40)] = True
    rows = spark.createDataFrame([(int(y), int(x)) for y, x in np.argwhere(mask)], "y int, x int")
    assert np.array_equal(array(shapes.squared_distance(rows, mask.shape), mask.shape, "d2"), kernels.squared_distances(mask))
    assert shapes.squared_distance(rows.limit(0), mask.shape).count() == 0
    for n in (1, 2, 501, 1000):
        v = rng.integers(-(10**9), 10**9, n)
        r = threshold.median_mad(spark.createDataFrame([(int(x),) for x in v], "v bigint").repartition(5)).first()
        assert r["med"] == np.median(v) and r["mad"] == np.median(np.abs(v - np.median(v)))


def test_large_chain_tiles(spark, cells):
    """Basins and seeds don't change with the tile."""
    _, pmap = cells
    one, many = (segment.LargeSegmentor(pmap, (60, 60), LargeConfig(overlap_size=16, mean_intensity_min=5, area_max=5000, footprint_size=5), t) for t in (60, 20))
    assert np.array_equal(array(one.segmented(), (60, 60), "label"), array(many.segmented(), (60, 60), "label"))
    assert sorted(map(tuple, one.seeds().collect())) == sorted(map(tuple, many.seeds().collect()))
    row_form, scale = neighbourhood.gaussian(pmap.select("y", "x", (255 - F.col("contour")).alias("v")), 1.0, (60, 60))
    unit = array(row_form, (60, 60)) / (float(scale) * 255)
    assert sorted(map(tuple, np.argwhere(kernels.h_maxima(unit, 0.01, 5)).tolist())) == sorted(map(tuple, one.seeds().collect()))
    # the whole chain in plain arrays: basins are larger than these tiles, whose overlap is nothing
    contour, seeds = array(pmap.select("y", "x", F.col("contour").alias("v")), (60, 60)), kernels.components(kernels.h_maxima(unit, 0.01, 5), 1)
    basins = kernels.flood(contour, seeds)
    small = segment.LargeSegmentor(pmap, (60, 60), LargeConfig(overlap_size=0, mean_intensity_min=5, area_max=5000, footprint_size=5), 9)
    found = array(small.segmented(), (60, 60), "label")
    pairs = set(zip(basins.ravel().tolist(), found.ravel().tolist(), strict=True))
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
