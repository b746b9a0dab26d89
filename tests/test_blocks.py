"""Array tiles against whole images, whatever the tile."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import blocks, kernels, neighbourhood


def rows(spark, **bands):
    """Pixels of equal arrays as rows."""
    first = next(iter(bands.values()))
    y, x = np.indices(first.shape)
    values = [np.asarray(a).ravel().tolist() for a in bands.values()]
    return spark.createDataFrame(list(zip(y.ravel().tolist(), x.ravel().tolist(), *values, strict=True)), "y int, x int" + "".join(f", {n} bigint" for n in bands))


def array(px, name, shape):
    out = np.zeros(shape, np.int64)
    for r in px.collect():
        out[r["y"], r["x"]] = r[name]
    return out


def smooth(a, n):
    for _ in range(n):
        a = (a + np.roll(a, 1, 0) + np.roll(a, 1, 1) + np.roll(a, -1, 0) + np.roll(a, -1, 1)) / 5
    return a


@pytest.mark.parametrize("tile", [7, 64])
def test_tiles_and_back(spark, tile):
    a = np.arange(45 * 33).reshape(45, 33)
    made = blocks.from_pixels(rows(spark, v=a).where("v % 5 <> 0"), a.shape, {"v": "<i4"}, tile)
    assert made.frame.count() == -(-45 // tile) * -(-33 // tile)
    assert (array(blocks.to_pixels(made), "v", a.shape) == np.where(a % 5, a, 0)).all()
    assert blocks.to_pixels(made, "v").count() == np.count_nonzero(a % 5)
    doubled = blocks.mapped(made, lambda arrays, box: {"w": arrays["v"] * 2}, {"w": "<i8"})
    assert (array(blocks.to_pixels(doubled), "w", a.shape) == np.where(a % 5, 2 * a, 0)).all()


def test_an_image_without_pixels(spark):
    none = spark.createDataFrame([], "y int, x int, v bigint")
    made = blocks.from_pixels(none, (20, 9), {"v": "<i4"}, 16, {"v": 3})
    assert (array(blocks.to_pixels(made), "v", (20, 9)) == 3).all()


@pytest.mark.parametrize(("sigma", "edge", "tile"), [(1.0, "reflect", 8), (2.0, "nearest", 16), (1.5, "constant", 19)])
def test_gaussian_on_tiles_is_that_of_rows(spark, sigma, edge, tile):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 4000, (41, 34))
    px = rows(spark, v=a)
    want, scale = neighbourhood.gaussian(px, sigma, a.shape, edge)
    got, s = blocks.gaussian(blocks.from_pixels(px, a.shape, {"v": "<i4"}, tile), sigma, edge)
    assert s == scale and (array(blocks.to_pixels(got), "v", a.shape) == array(want, "v", a.shape)).all()


def test_strips_are_all_that_a_neighbour_gets(spark):
    a = np.random.default_rng(0).integers(0, 60_000, (512, 512))
    made = blocks.from_pixels(rows(spark, v=a[:256, :256]), (256, 256), {"v": "<u2"}, 128)
    sent = blocks._strips(made, 4).agg(F.sum(F.length("v"))).first()[0]
    assert sent < 1.2 * made.frame.agg(F.sum(F.length("v"))).first()[0]
    with pytest.raises(ValueError):
        blocks.stencil(made, 129, lambda *a: a, {})


def surface(seed, shape, rounds, levels):
    return (smooth(np.random.default_rng(seed).random(shape), rounds) * levels).astype(int)


def settled(step, arrays, tile, earliest=None):
    """What ``blocks.relaxed`` does, over arrays: the bands found, and the rounds."""
    shape = next(iter(arrays.values())).shape
    plan = blocks.Blocks(None, shape, tile, {})
    ny, nx = plan.grid
    heard = {(ty, tx): {} for ty in range(ny) for tx in range(nx)}
    dirty, out, until, ran, fewest = set(heard), {}, None, {}, float("inf")
    for k in range(1, 2000):
        said = {}
        for ty, tx in dirty:
            b = plan.box(ty, tx)
            found, sent = step({n: a[b[0] : b[1], b[2] : b[3]] for n, a in arrays.items()}, b, {k: v for k, v in heard[ty, tx].items() if v}, until, None if until else ran.get((ty, tx)))
            ran[ty, tx] = found
            for n, a in found.items():
                out.setdefault(n, np.zeros(shape, np.int64))[b[0] : b[1], b[2] : b[3]] = a
            said[ty, tx] = sent
        news = {}
        for (ty, tx), sent in said.items():
            for (dy, dx), data in sent.items():
                to, side = (ty + dy, tx + dx), (-dy, -dx)
                if to in heard and (was := heard[to].get(side, b"")) != data:
                    news.setdefault(to, []).append((was, data))
                    heard[to][side] = data
        dirty = set(news)
        if until is not None:
            dirty, until = {t for t, rim in heard.items() if any(rim.values())}, None
        elif earliest and news and k % blocks.PATIENCE == 0 and (n := sum(map(len, news.values()))) < fewest:
            fewest = n
        elif earliest and news and k % blocks.PATIENCE == 0:
            fewest = float("inf")
            until = min(earliest(*m) for ms in news.values() for m in ms)
            dirty = {t for t, rim in heard.items() if any(rim.values())}
        if not dirty:
            return out, k
    raise RuntimeError("not settled")


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 40), st.integers(2, 13), st.integers(0, 6), st.sampled_from([4, 30, 300]), st.integers(1, 6), st.booleans(), st.booleans())
def test_flood_of_any_surface_does_not_depend_on_the_tile(seed, h, w, tile, rounds, levels, k, line, masked):
    rng = np.random.default_rng(seed)
    s = (smooth(rng.random((h, w)), rounds) * levels).astype(int)
    m = np.zeros((h, w), np.int64)
    m[rng.integers(0, h, k), rng.integers(0, w, k)] = np.arange(1, k + 1)
    arrays = {"v": s, "label": m} | ({"mask": rng.random((h, w)) > 0.2} if masked else {})
    got, _ = settled(blocks.flooding(mask="mask" if masked else None, line=line), arrays, tile, blocks.first_difference)
    assert (got["label"] == kernels.flood(s, m, arrays.get("mask"), line)).all()


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.integers(1, 40), st.integers(3, 13), st.integers(1, 60), st.sampled_from([3, 5, 7]))
def test_reconstruction_of_any_image_does_not_depend_on_the_tile(seed, h, w, tile, drop, side):
    s = surface(seed, (h, w), seed % 5, 200)
    low = lambda a: a - drop
    got, _ = settled(blocks.rising(low, "v", side), {"v": s}, tile)
    now = np.minimum(s - drop, s)
    while not np.array_equal(now, grown := np.minimum(kernels._window_max(now, side), s)):
        now = grown
    assert (got["low"] == now).all()


def test_flood_on_tiles_of_three_sizes(spark):
    shape = (70, 61)
    s = surface(3, shape, 6, 900)
    rng = np.random.default_rng(3)
    m = np.zeros(shape, np.int64)
    m[rng.integers(0, 70, 5), rng.integers(0, 61, 5)] = np.arange(1, 6)  # basins of many tiles
    open_ = rng.random(shape) > 0.08
    px = rows(spark, v=s, label=m, mask=open_.astype(int))
    whole = kernels.flood(s, m, open_)
    for tile in (20, 33, 70):
        made = blocks.from_pixels(px, shape, {"v": "<i4", "label": "<i8", "mask": "<u1"}, tile)
        got = array(blocks.to_pixels(blocks.flooded(made, mask="mask")), "label", shape)
        assert (got == whole).all(), tile


def test_reconstruction_on_tiles(spark):
    shape = (50, 47)
    s = surface(4, shape, 2, 200)
    s[10:40, 5] = s[10, 5:40] = 190  # a ridge through many tiles
    made = blocks.from_pixels(rows(spark, v=s), shape, {"v": "<i4"}, 20)
    got = blocks.reconstructed(made, lambda a: a - 30, "v", 5)
    assert (array(blocks.to_pixels(got), "low", shape) == kernels.reconstruct(s - 30, s, 5)).all()
