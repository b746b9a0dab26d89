"""Distances, erosion, components and floods of many values on array tiles, against whole images."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera import registry
from tessera.operators import blocks, components, kernels, neighbourhood
from tessera.plans import segment
from tessera.plans.config import SegmentConfig


def rows(spark, mask, **more):
    y, x = np.nonzero(mask)
    values = [np.asarray(a)[y, x].tolist() for a in more.values()]
    return spark.createDataFrame(list(zip(y.tolist(), x.tolist(), *values, strict=True)), "y int, x int" + "".join(f", {n} bigint" for n in more))


def array(px, shape, name=None):
    out = np.zeros(shape, np.int64)
    for r in px.collect():
        out[r["y"], r["x"]] = r[name] if name else 1
    return out


def whole(spark, mask, tile):
    return blocks.from_pixels(rows(spark, mask, on=mask.astype(int)), mask.shape, {"on": "?"}, tile)


@pytest.mark.parametrize(("tile", "across"), [(7, 1 << 21), (16, 90), (64, 1 << 21)])
def test_distances_on_tiles(spark, tile, across, monkeypatch):
    monkeypatch.setattr(blocks, "ACROSS", across)
    rng = np.random.default_rng(tile)
    mask = np.zeros((45, 33), bool)
    mask[rng.integers(0, 45, 4), rng.integers(0, 33, 4)] = True
    got = blocks.to_pixels(blocks.squared_distances(whole(spark, mask, tile), "on"))
    assert (array(got, mask.shape, "d2") == kernels.squared_distances(mask)).all() and got.count() == mask.size


@pytest.mark.parametrize("connectivity", [1, 2])
def test_components_joined_across_tiles(spark, connectivity):
    mask = np.random.default_rng(5).random((30, 26)) > 0.45
    named = blocks.mapped(whole(spark, mask, 7), lambda arrays, box: {"part": components.pieces(arrays["on"], box, 26, connectivity)}, {"part": "<i8"})
    got = array(blocks.to_pixels(components.joined_up(named, "part", connectivity)), mask.shape, "part")
    pairs = set(zip(got.ravel().tolist(), kernels.components(mask, connectivity).ravel().tolist(), strict=True))
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_erosion_on_tiles(spark):
    mask = np.random.default_rng(6).random((25, 31)) > 0.03
    for beyond in (False, True):
        wide = np.pad(mask, 2, constant_values=beyond)
        want = np.array([[all(wide[y + 2 + a, x + 2 + b] for a, b in neighbourhood.disk(2)) for x in range(31)] for y in range(25)])
        got = blocks.to_pixels(blocks.eroded(whole(spark, mask, 9), "on", neighbourhood.disk(2), beyond), "on")
        assert (array(got, mask.shape) == want).all()


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 24), st.integers(2, 24), st.sampled_from([3, 40, 10**6]), st.integers(1, 6), st.booleans())
def test_pixels_and_waves_flood_alike_among_events(seed, h, w, levels, k, line):
    rng = np.random.default_rng(seed)
    s = (rng.random((h, w)) * levels).astype(int).astype(float)
    m = np.zeros((h, w), np.int64)
    m[rng.integers(0, h, k), rng.integers(0, w, k)] = np.arange(1, k + 1)
    edge = np.zeros(w, kernels.EVENT)
    edge["label"], edge["level"], edge["wave"] = rng.integers(0, 4, w), (rng.random(w) * levels).astype(int), rng.integers(-1, 4, w)
    found = []
    for form in (kernels._pixels_among, kernels._waves_among):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(kernels, "_pixels_among", form)
            patch.setattr(kernels, "_waves_among", form)
            found.append(kernels.flood_open(s, m, {(-1, 0): edge}, None, line))
    assert (found[0] == found[1]).all()


def test_rounds_keep_nothing_but_rows(spark, tmp_path):
    """What Spark has inferred of the columns would grow from round to round, and planning with it."""
    edges = spark.createDataFrame([(0, 1), (1, 2), (5, 6)], "a bigint, b bigint")
    kept = components._written(edges.where("a <> b and a < 9"), f"{tmp_path}/kept")
    assert kept._jdf.queryExecution().analyzed().constraints().isEmpty() and kept.count() == 3
    assert sorted(map(tuple, components.contract(edges).collect())) == [(0, 0), (1, 0), (2, 0), (5, 5), (6, 5)]


def test_cells_do_not_depend_on_the_tile(spark):
    """Basins that are larger than the tiles and their halo."""
    rng, size = np.random.default_rng(2), (48, 40)
    nuclei = np.zeros(size, np.int64)
    for k, (y, x) in enumerate([(14, 12), (17, 29), (34, 20)]):
        nuclei[y - 1 : y + 2, x - 1 : x + 2] = k + 1
    tissue = kernels.squared_distances(nuclei > 0) < 60
    image = rng.integers(0, 200, size)
    px = rows(spark, nuclei > 0, label=nuclei)
    found = [array(segment.cytoplasm(px, rows(spark, image > 0, v=image), rows(spark, tissue), size, SegmentConfig(cyto_dilation=3), "hybrid", tile, 1).cell, size, "label") for tile in (9, 48)]
    assert found[1].max() > 0 and (found[0] == found[1]).all()


def test_background_reaches_the_border(spark):
    """Beyond the image is no tissue: a nucleus beside the border keeps its cell, as the background has the border itself."""
    size, nuclei = (40, 40), np.zeros((40, 40), np.int64)
    nuclei[6:9, 18:21] = 1
    tissue = kernels.squared_distances(nuclei > 0) < 4
    image = np.where(tissue, 100, 0)
    px = rows(spark, nuclei > 0, label=nuclei)
    marks = blocks.from_pixels(rows(spark, tissue | (nuclei > 0), within=tissue.astype(int), nucleus=(nuclei > 0).astype(int)), size, {"within": "?", "nucleus": "?"}, 16)
    got = array(blocks.to_pixels(segment._with_background(marks, 3), "label"), size, "label")
    far = kernels.squared_distances(tissue) > 9
    assert ((got > 0) == (far | (nuclei > 0))).all() and len(np.unique(got)) == 3
    cells = segment.cytoplasm(px, rows(spark, image > 0, v=image), rows(spark, tissue), size, SegmentConfig(cyto_dilation=3), "hybrid", 16).cell
    assert cells.select("label").distinct().count() == 1


def test_cells_of_the_probability_map_touch(spark, tmp_path):
    spark.range(40).selectExpr("id AS s_suppkey", "CAST(id % 25 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    blobs, _ = registry._blobs(spark, str(tmp_path))
    pmap, cells, size = registry._pmap(spark, str(tmp_path))
    got, own = array(cells, size, "label"), array(blobs, size, "label")
    near = kernels.squared_distances(own > 0)
    assert ((got > 0) == (near <= 16)).all() and cells.count() == np.count_nonzero(got)
    assert (got[own > 0] == own[own > 0]).all()
    assert any(((a != b) & (a > 0) & (b > 0)).any() for a, b in ((got[1:], got[:-1]), (got[:, 1:], got[:, :-1])))
    v = array(blobs, size, "v")
    assert (array(cells, size, "v") == v).all() and (array(pmap, size, "center") == v).all()
