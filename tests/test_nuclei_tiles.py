"""Nuclei of the local modes against whole arrays: seeds, basins and their measures don't change with the tile."""

import numpy as np
import pytest

from tessera.operators import kernels
from tessera.plans import segment
from tessera.plans.config import SegmentConfig


def rows(spark, **bands):
    y, x = np.indices(next(iter(bands.values())).shape)
    values = [np.asarray(a).ravel().tolist() for a in bands.values()]
    return spark.createDataFrame(list(zip(y.ravel().tolist(), x.ravel().tolist(), *values, strict=True)), "y int, x int" + "".join(f", {n} int" for n in bands))


def array(px, shape):
    out = np.zeros(shape, np.int64)
    for r in px.collect():
        out[r["y"], r["x"]] = r["label"]
    return out


def smooth(a, n):
    for _ in range(n):
        a = (a + np.roll(a, 1, 0) + np.roll(a, 1, 1) + np.roll(a, -1, 0) + np.roll(a, -1, 1)) / 5
    return a


def whole(center, contour, h, low, high):
    """Every step on the whole image; a basin is what one seed floods."""
    seeds = kernels.components(kernels.window_peaks(kernels.h_maxima(255 - contour, h).astype(np.int8)), 2)
    basins = kernels.flood(contour, seeds)
    dim = (center.max() - center - contour) % 256
    kept = [k for k in np.unique(basins[basins > 0]) if low < (basins == k).sum() < high and dim[basins == k].mean() < 50]
    return seeds.max(), len(kept), kernels.components(np.isin(basins, kept), 1)


@pytest.mark.parametrize("tile", [9, 50])
def test_local_nuclei_do_not_depend_on_the_tile(spark, tile):
    rng = np.random.default_rng(11)
    raw = smooth(rng.random((50, 43)), 2)
    contour = ((raw - raw.min()) / (raw.max() - raw.min()) * 255).astype(int)
    center = np.clip(255 - contour - rng.integers(0, 60, contour.shape), 0, 255)
    config = SegmentConfig(log_sigma=(4, 40), nuclei_region="localMax")
    seeds, kept, want = whole(center, contour, 4, 12, 1200)
    assert seeds > kept > 3  # basins larger than the tiles, and some that go
    got = segment.nuclei(rows(spark, center=center, contour=contour), None, None, contour.shape, config, tile, 1)
    assert (array(got, contour.shape) == want).all()


def test_a_flat_map_has_no_nuclei(spark):
    flat = np.full((12, 12), 100)
    assert segment.nuclei_local(rows(spark, center=flat, contour=flat), flat.shape, SegmentConfig(log_sigma=(1, 40)), 5).count() == 0
