"""The window kernel: smoothing in integers, and components of the wrong size left out."""

import numpy as np
import pandas as pd

from tessera import registry
from tessera.operators import kernels, neighbourhood
from tessera.plans import segment
from tessera.plans.config import SegmentConfig


def discs(*radii):
    """Discs beside each other, bright in the middle."""
    v = np.zeros((40, 30 * len(radii)), np.int64)
    y, x = np.indices(v.shape)
    for k, r in enumerate(radii):
        d = (y - 20) ** 2 + (x - 30 * k - 15) ** 2
        v = np.where(d < r * r, 255 - 200 * d // (r * r), v)
    return v


def rows(v):
    y, x = (a.ravel() for a in np.indices(v.shape))
    return pd.DataFrame({"y": y, "x": x, "contour": 255 - v.ravel(), "tissue": v.ravel() > 0})


def run(v, **more):
    found = segment.seed_kernel(v.shape, 1.0, 1.0, **more)(rows(v), (0, v.shape[0], 0, v.shape[1]))
    out = np.zeros(v.shape, bool)
    out[found.y, found.x] = True
    return out


def test_sizes_are_judged_in_the_window():
    v = discs(3, 7, 12)
    small, middle, large = ((v > 0) & (np.arange(v.shape[1]) // 30 == k) for k in range(3))
    assert (run(v) == (v > 0)).all()
    assert (run(v, area=(small.sum(), large.sum())) == middle).all()  # both ends excluded
    assert (run(v, area=(small.sum() - 1, large.sum() + 1)) == (v > 0)).all()


def test_smoothing_cuts_after_each_axis():
    assert (segment._stored_smooth(np.full((9, 12), 255), 1.3) == 255).all()
    a = np.random.default_rng(1).integers(0, 256, (17, 13))
    w = neighbourhood.gaussian_weights(1.0)
    want = a
    for axis in (0, 1):
        wide = np.pad(want, [(4, 4) if k == axis else (0, 0) for k in (0, 1)], mode="symmetric")
        want = np.array([[sum(k * int(wide[y + (i if axis == 0 else 0), x + (i if axis == 1 else 0)]) for i, k in enumerate(w)) // sum(w) for x in range(13)] for y in range(17)])
    assert (segment._stored_smooth(a, 1.0) == want).all()


def test_the_query_judges_sizes(spark, tmp_path, monkeypatch):
    spark.range(40).selectExpr("id AS s_suppkey", "CAST(id % 25 AS INT) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    found = {}
    for name, diameters in (("all", (0, 1000)), ("some", (3, 18))):
        monkeypatch.setattr(registry, "CONFIG", SegmentConfig(log_sigma=diameters))
        found[name] = np.zeros((64, 768), bool)
        for r in registry.QUERIES["l9_window_kernel"](spark, str(tmp_path)).collect():
            found[name][r["y"], r["x"]] = True
    parts = kernels.components(found["all"])
    n = np.bincount(parts.ravel())
    n[0] = 0
    assert (n >= 243).any() and (found["some"] == ((n > 6.75) & (n < 243))[parts]).all()
