"""Cells from rings read pixels that no plan broadcasts."""

import numpy as np
import pytest

from tessera.operators import kernels, neighbourhood
from tessera.plans import segment


def test_cells_from_ring_make_no_row_for_each_offset(spark):
    labels = spark.createDataFrame([(4, 4, 7), (4, 15, 3)], "y int, x int, label bigint")
    basins = neighbourhood.ring(labels, 3, (9, 20))
    assert "dx" not in basins._jdf.queryExecution().toString()
    cells = segment.cell_assembly(basins, labels, basins, (9, 20))
    assert {(r.y, r.x, r.label) for r in cells.nuclei.collect()} == {(4, 4, 1), (4, 15, 2)}
    assert cells.cyto.count() == 2 * (len(neighbourhood.disk(3)) - 1)


def test_no_pixels_are_joined_to_part_cells(spark):
    labels = spark.createDataFrame([(4, 4, 7), (4, 15, 3)], "y int, x int, label bigint")
    cells = segment.cell_assembly(neighbourhood.ring(labels, 3, (9, 20)), labels, labels, (9, 20))
    for part in (cells.cyto, cells.nuclei):
        assert "hashpartitioning(y" not in part._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("method", ["tiles", "rows"])
def test_cells_across_seams(spark, method):
    """Against whole arrays: pixels beyond the image are seen, label 0 is a label, and of two at a place the smaller counts."""
    rng, size, r = np.random.default_rng(8), (40, 33), 2
    seeds = [(int(y), int(x), k) for k, (y, x) in enumerate(zip(rng.integers(-1, 41, 75), rng.integers(-1, 34, 75), strict=True))]
    seeds.append((*seeds[1][:2], 99))
    px = spark.createDataFrame(seeds, "y int, x int, label bigint")
    ring, nucleus = np.full(size, -1), np.zeros(size, bool)
    for y, x in np.ndindex(size):
        d2, label = min(((y - a) ** 2 + (x - b) ** 2, k) for a, b, k in seeds)
        ring[y, x], nucleus[y, x] = label if d2 <= r * r else -1, d2 == 0
    within = rng.random(size) > (0 if method == "tiles" else 0.2)
    if method == "tiles":
        cells = segment.ring_cells(px, r, size, 7)
    else:
        mask = spark.createDataFrame([(int(y), int(x)) for y, x in zip(*np.nonzero(within), strict=True)], "y int, x int")
        cells = segment.cell_assembly(neighbourhood.ring(px, r, size), px, mask, size, 7)
    border = np.concatenate([ring[0], ring[-1], ring[:, 0], ring[:, -1]])
    parts = kernels.components((ring >= 0) & ~np.isin(ring, border) & within)
    named = [k for k in np.unique(parts[parts > 0]) if nucleus[parts == k].any()]
    want = {(y, x, named.index(parts[y, x]) + 1, bool(nucleus[y, x])) for y, x in np.argwhere(np.isin(parts, named)).tolist()}
    got = cells.parted.collect()
    assert {tuple(p) for p in got} == want and len(got) == len(want)
    assert len(named) > 3 and 0 in ring and (parts.max() > len(named) or method == "tiles")
    assert {tuple(p) for p in cells.cyto.collect()} == {p[:3] for p in want if not p[3]}
