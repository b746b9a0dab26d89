"""Array kernels against brute force on small arrays, and on shapes that trip such kernels up."""

import heapq

import numpy as np
import pytest

from tessera.operators import kernels as K


def spiral(n):
    a = np.zeros((n, n), bool)
    y, x, dy, dx = 0, 0, 0, 1
    seen = set()
    while True:
        a[y, x] = True
        seen.add((y, x))
        v, u = y + dy, x + dx
        ahead = (v + dy, u + dx)
        if not (0 <= v < n and 0 <= u < n) or ahead in seen or (v, u) in seen:
            dy, dx = dx, -dy
            v, u = y + dy, x + dx
            if not (0 <= v < n and 0 <= u < n) or (v, u) in seen or (v + dy, u + dx) in seen:
                return a
        y, x = v, u


def brute_label(mask, steps):
    out, n = np.zeros(mask.shape, int), 0
    for y, x in zip(*np.nonzero(mask), strict=True):
        if out[y, x]:
            continue
        n += 1
        todo = [(y, x)]
        out[y, x] = n
        while todo:
            a, b = todo.pop()
            for dy, dx in steps:
                v, u = a + dy, b + dx
                if 0 <= v < mask.shape[0] and 0 <= u < mask.shape[1] and mask[v, u] and not out[v, u]:
                    out[v, u] = n
                    todo.append((v, u))
    return out


MASKS = [np.zeros((5, 6), bool), np.ones((7, 3), bool), np.eye(6, dtype=bool), spiral(15), np.random.default_rng(0).random((16, 16)) > 0.5, np.random.default_rng(1).random((12, 9)) > 0.35, np.array([[1]], bool)]


@pytest.mark.parametrize("mask", MASKS)
def test_components(mask):
    assert np.array_equal(K.components(mask, 1), brute_label(mask, K.FOUR))
    assert np.array_equal(K.components(mask, 2), brute_label(mask, K.EIGHT))


def test_squared_distances():
    for mask in MASKS:
        got = K.squared_distances(mask)
        members = np.argwhere(mask)
        for y in range(mask.shape[0]):
            for x in range(mask.shape[1]):
                if len(members):
                    assert got[y, x] == ((members - (y, x)) ** 2).sum(axis=1).min()


def test_reconstruction_and_h_maxima():
    rng = np.random.default_rng(2)
    image = rng.integers(0, 20, (12, 12))
    for h in (1, 3, 7):
        # a pixel's residue: how far below it the lowest pass to anything h lower must go
        limit, seed = image, image - h
        now = seed.copy()
        while True:  # plain repeated dilation, pixel by pixel
            p = np.pad(now, 1, constant_values=-100)
            grown = np.array([[min(limit[y, x], p[y : y + 3, x : x + 3].max()) for x in range(12)] for y in range(12)])
            if np.array_equal(grown, now):
                break
            now = grown
        assert np.array_equal(K.h_maxima(image, h), image - now >= h)
    plateau = np.zeros((5, 9), int)
    plateau[2, 2:7] = 4
    assert np.array_equal(K.h_maxima(plateau, 2), plateau == 4)


def test_flood_invariants():
    rng = np.random.default_rng(3)
    surface = rng.integers(0, 9, (16, 16))
    markers = np.zeros((16, 16), int)
    for k, (y, x) in enumerate(((2, 2), (3, 13), (13, 4), (12, 12)), 1):
        markers[y, x] = k
    out = K.flood(surface, markers)
    assert set(np.unique(out)) == {0, 1, 2, 3, 4}
    for a, b in ((out[1:], out[:-1]), (out[:, 1:], out[:, :-1])):
        assert not ((a > 0) & (b > 0) & (a != b)).any()  # a line parts any two basins
    whole = K.flood(surface, markers, line=False)
    assert (whole > 0).all() and all(len(np.unique(brute_label(whole == k, K.FOUR))) == 2 for k in (1, 2, 3, 4))
    mask = np.zeros((16, 16), bool)
    mask[:, :8] = True
    inside = K.flood(surface, markers, mask)
    assert not inside[:, 8:].any() and set(np.unique(inside)) <= {0, 1, 3}


def test_flood_follows_heights():
    surface = np.array([[0, 1, 9, 1, 0]])
    assert K.flood(surface, np.array([[1, 0, 0, 0, 2]])).tolist() == [[1, 1, 0, 2, 2]]
    # least highest pass from a marker, as a shortest path would have it
    rng = np.random.default_rng(4)
    surface = rng.permutation(144).reshape(12, 12)
    markers = np.zeros((12, 12), int)
    markers[0, 0], markers[11, 11] = 1, 2
    cost = {}
    for k, start in ((1, (0, 0)), (2, (11, 11))):
        best, queue = {start: surface[start]}, [(surface[start], start)]
        while queue:
            c, (y, x) = heapq.heappop(queue)
            for dy, dx in K.FOUR:
                q = (y + dy, x + dx)
                if 0 <= q[0] < 12 and 0 <= q[1] < 12 and max(c, surface[q]) < best.get(q, 10**6):
                    best[q] = max(c, surface[q])
                    heapq.heappush(queue, (best[q], q))
        cost[k] = best
    out = K.flood(surface, markers, line=False)
    assert all(cost[out[y, x]][y, x] == min(cost[1][y, x], cost[2][y, x]) for y in range(12) for x in range(12))


def test_hull():
    square = np.argwhere(np.ones((4, 5)))
    assert K.hull_area(square[:, 0], square[:, 1]) == 20
    corner = np.argwhere(np.array([[1, 0, 0, 0], [1, 0, 0, 0], [1, 0, 0, 0], [1, 1, 1, 1]]))
    assert len(corner) / K.hull_area(corner[:, 0], corner[:, 1]) < 0.8
    assert K.hull_area(np.array([3]), np.array([7])) == 1


def test_window_peaks():
    a = np.zeros((6, 6), int)
    a[2, 2] = a[3, 4] = 5
    a[0, 5] = 9
    assert np.argwhere(K.window_peaks(a)).tolist() == [[2, 2], [3, 4]]


@pytest.mark.parametrize("line", [True, False])
def test_flood_paths_agree(line, monkeypatch):
    rng = np.random.default_rng(12)
    for k in range(12):
        surface = rng.integers(0, 6, (25, 30)) if k % 2 else rng.integers(0, 2, (25, 30))
        markers = np.where(rng.random((25, 30)) < 0.05, rng.integers(1, 9, (25, 30)), 0)
        mask = rng.random((25, 30)) < 0.9 if k % 3 else None
        by_wave = K.flood(surface, markers, mask, line)
        with monkeypatch.context() as m:
            m.setattr(K, "_waves", K._pixels)
            assert np.array_equal(K.flood(surface, markers, mask, line), by_wave)


def test_h_maxima_of_floats():
    image = np.zeros((5, 5))
    image[2, 2] = 255
    assert K.h_maxima(image, 0.01)[2, 2] and K.h_maxima(image / 255, 0.01)[2, 2]


def test_distances_rows_and_footprint():
    rng = np.random.default_rng(21)
    for h, w, n in ((1, 1, 1), (7, 31, 3), (40, 65, 9), (30, 17, 60), (12, 200, 1)):
        mask = np.zeros((h, w), bool)
        mask[rng.integers(0, h, n), rng.integers(0, w, n)] = True
        y, x = np.indices((h, w))
        want = np.min([(y - a) ** 2 + (x - b) ** 2 for a, b in zip(*np.nonzero(mask), strict=True)], axis=0)
        assert np.array_equal(K.squared_distances(mask), want)
    a = rng.integers(0, 30, (25, 30))
    for size in (1, 3, 5):
        p = np.pad(a, size // 2, mode="edge")
        want = np.array([[p[y : y + size, x : x + size].max() for x in range(30)] for y in range(25)])
        assert np.array_equal(K._window_max(a, size), want)
        now = np.minimum(a - 4, a)  # reconstruction, pixel by pixel
        while True:
            q = np.pad(now, size // 2, mode="edge")
            new = np.array([[min(q[y : y + size, x : x + size].max(), a[y, x]) for x in range(30)] for y in range(25)])
            if np.array_equal(new, now):
                break
            now = new
        assert np.array_equal(K.h_maxima(a, 4, size), a - now >= 4)
    with pytest.raises(ValueError):
        K._window_max(a, 4)


def test_no_seed_on_the_border():
    peaks = np.zeros((9, 9), np.int8)
    peaks[0, 4] = peaks[4, 8] = peaks[5, 5] = 1
    assert np.argwhere(K.window_peaks(peaks)).tolist() == [[5, 5]]
