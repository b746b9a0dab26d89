"""Array kernels for what rows can't say: components, reconstruction, flooding, distances, hulls. Plain numpy."""

from __future__ import annotations

import heapq

import numpy as np

FOUR = ((-1, 0), (0, -1), (0, 1), (1, 0))
EIGHT = tuple((a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b)


def _minimum_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least member of each node's component, from edge arrays over range(n)."""
    low = np.arange(n)
    while len(a):
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, low[a], m)
        np.minimum.at(low, low[b], m)
        low = low[low]
        low = low[low]
        live = low[a] != low[b]
        a, b = a[live], b[live]
    while True:
        up = low[low]
        if np.array_equal(up, low):
            return low
        low = up


def components(mask: np.ndarray, connectivity: int = 1) -> np.ndarray:
    """Labels from 1 in the order of each component's first pixel by rows; connectivity 1 is across edges, 2 corners too."""
    h, w = mask.shape
    index = np.arange(h * w).reshape(h, w)
    pairs = [(slice(None), slice(0, -1), slice(None), slice(1, None)), (slice(0, -1), slice(None), slice(1, None), slice(None))]
    if connectivity == 2:
        pairs += [(slice(0, -1), slice(0, -1), slice(1, None), slice(1, None)), (slice(0, -1), slice(1, None), slice(1, None), slice(0, -1))]
    a, b = [], []
    for y0, x0, y1, x1 in pairs:
        on = mask[y0, x0] & mask[y1, x1]
        a.append(index[y0, x0][on])
        b.append(index[y1, x1][on])
    low = _minimum_labels(np.concatenate(a), np.concatenate(b), h * w)
    out = np.zeros(h * w, np.int64)
    on = mask.ravel()
    out[on] = np.unique(low[on], return_inverse=True)[1] + 1
    return out.reshape(h, w)


def _window_max(a: np.ndarray, size: int = 3) -> np.ndarray:
    """Maximum over windows of an odd ``size``, the image's edge repeated."""
    if size % 2 == 0:
        raise ValueError("a window has a middle pixel, so its size is odd")
    for flip in (False, True):  # down the columns, then along the rows; beyond the edge there is nothing new
        a = a.T if flip else a
        out = a.copy()
        for k in range(1, min(size // 2, len(a) - 1) + 1):
            np.maximum(out[k:], a[:-k], out=out[k:])
            np.maximum(out[:-k], a[k:], out=out[:-k])
        a = out.T if flip else out
    return a


def reconstruct(seed: np.ndarray, limit: np.ndarray, size: int = 3, rose: np.ndarray | None = None) -> np.ndarray:
    """Grey reconstruction by dilation over square windows.

    Whole passes as long as much changes, then a queue: only pixels that see one which rose are looked at again. Where ``seed``
    is a reconstruction but for some pixels that ``rose``, the queue begins with these.
    """
    now = np.minimum(seed, limit)
    while rose is None:
        grown = np.minimum(_window_max(now, size), limit)
        changed = grown != now
        now = grown
        n = np.count_nonzero(changed)
        if not n:
            return now
        if n * 16 * size * size < now.size:
            rose = changed
    r = size // 2
    h, w = now.shape
    wide = w + 2 * r
    least = now.min()
    flat, most = (np.pad(a, r, constant_values=least).ravel() for a in (now, limit))
    steps = np.array([dy * wide + dx for dy in range(-r, r + 1) for dx in range(-r, r + 1) if dy or dx])
    at = np.flatnonzero(np.pad(rose, r).ravel())
    while len(at):
        near = (at[:, None] + steps).ravel()
        near = np.unique(near[most[near] > flat[near]])
        value = np.minimum(flat[near[:, None] + steps].max(axis=1, initial=least), most[near])
        up = value > flat[near]
        at = near[up]
        flat[at] = value[up]
    return flat.reshape(h + 2 * r, wide)[r : r + h, r : r + w]


def h_maxima(image: np.ndarray, h: float, size: int = 3) -> np.ndarray:
    """Maxima that stand at least ``h`` above the saddle to a higher one; with h 0 the plain regional maxima.

    A saddle leads from pixel to pixel within windows of ``size``.
    """
    if h <= 0:
        step = 1 if np.issubdtype(image.dtype, np.integer) else np.finfo(float).eps * max(1.0, float(np.abs(image).max(initial=0)))
        return image - reconstruct(image - step, image, size) > 0
    slack = 0 if np.issubdtype(image.dtype, np.integer) else 4 * float(np.spacing(np.abs(image).max(initial=h)))
    return image - reconstruct(image - h, image, size) >= h - slack


def window_peaks(image: np.ndarray, border: int = 1) -> np.ndarray:
    """Pixels equal to their 3 x 3 maximum and above the least pixel, away from the border."""
    out = (image == _window_max(image)) & (image > image.min(initial=0))
    if border:
        out[:border] = out[-border:] = False
        out[:, :border] = out[:, -border:] = False
    return out


def flood(surface: np.ndarray, markers: np.ndarray, mask: np.ndarray | None = None, line: bool = True) -> np.ndarray:
    """Marker-controlled watershed across edges, in waves.

    The level rises over the surface's values. At a level, pixels beside a basin that are not above it form a wave:
    each takes its basins' label, or with ``line`` stays 0 and parts them if it sees two. Of pixels in one wave that
    touch and have different labels the first by rows takes its own and the other stays 0. What a wave reaches
    is the next wave, so a lower place behind a pass is flooded at the level of the pass. Markers outside the mask are
    dropped. Surfaces with few values go wave by wave as arrays, others pixel by pixel; the result is the same.
    """
    h, w = surface.shape
    wide = w + 2
    out = np.zeros((h + 2, wide), np.int64)
    closed = np.ones((h + 2, wide), bool)
    closed[1:-1, 1:-1] = False if mask is None else ~mask
    out[1:-1, 1:-1] = np.where(closed[1:-1, 1:-1], 0, markers)
    values, rank = np.unique(surface, return_inverse=True)
    level = np.zeros((h + 2, wide), np.int64)
    level[1:-1, 1:-1] = rank.reshape(h, w)
    out, level, done = out.ravel(), level.ravel(), (closed | (out > 0)).ravel()
    run = _waves if len(values) * 16 <= surface.size else _pixels
    run(out, level, done, np.array([-wide, -1, 1, wide]), len(values), line)
    return out.reshape(h + 2, wide)[1:-1, 1:-1]


def _waves(out: np.ndarray, level: np.ndarray, done: np.ndarray, steps: np.ndarray, levels: int, line: bool) -> None:
    waiting: list[list[np.ndarray]] = [[] for _ in range(levels)]

    def reach(kept: np.ndarray, now: int) -> np.ndarray:
        """Queue what ``kept`` touches; returns what is due at this level."""
        near = (kept[:, None] + steps).ravel()
        near = np.unique(near[~done[near]])
        done[near] = True
        due = level[near] <= now
        later = near[~due]
        if len(later):
            order = np.argsort(level[later], kind="stable")
            at, first = np.unique(level[later][order], return_index=True)
            for k, part in zip(at.tolist(), np.split(later[order], first[1:]), strict=True):
                waiting[k].append(part)
        return near[due]

    reach(np.flatnonzero(out), -1)
    place = np.full(len(out), -1)
    for now in range(levels):
        wave = np.sort(np.concatenate(waiting[now])) if waiting[now] else np.empty(0, np.int64)
        waiting[now] = []
        while len(wave):
            seen = out[wave[:, None] + steps]
            high = seen.max(axis=1)
            low = np.where(seen > 0, seen, high[:, None]).min(axis=1)
            if not line:
                first = np.argmax(seen > 0, axis=1)
                out[wave] = seen[np.arange(len(wave)), first]
                wave = reach(wave, now)
                continue
            alive = np.flatnonzero(low == high)  # sees one basin
            pixel, label = wave[alive], high[alive]
            place[pixel] = np.arange(len(pixel))
            other = place[pixel[:, None] + steps]
            rival = (other >= 0) & (label[other] != label[:, None])
            state = np.zeros(len(pixel), np.int8)  # 0 open, 1 kept, 2 line
            state[~rival.any(axis=1)] = 1
            earlier = rival & (other < np.arange(len(pixel))[:, None])
            while True:
                open_ = np.flatnonzero(state == 0)
                if not len(open_):
                    break
                theirs = np.where(earlier[open_], state[other[open_]], 2)
                state[open_[(theirs == 1).any(axis=1)]] = 2
                state[open_[(theirs == 2).all(axis=1)]] = 1
            place[pixel] = -1
            kept = pixel[state == 1]
            out[kept] = label[state == 1]
            wave = reach(kept, now)


def _pixels(out: np.ndarray, level: np.ndarray, done: np.ndarray, steps: np.ndarray, levels: int, line: bool) -> None:
    around = steps.tolist()
    labels, heights, closed = out.tolist(), level.tolist(), done.tolist()
    queue: list[tuple[int, int]] = []

    def reach(kept: list[int], now: int) -> list[int]:
        due = []
        for p in kept:
            for s in around:
                q = p + s
                if not closed[q]:
                    closed[q] = True
                    if heights[q] <= now:
                        due.append(q)
                    else:
                        heapq.heappush(queue, (heights[q], q))
        return sorted(due)

    reach(np.flatnonzero(out).tolist(), -1)
    while queue:
        now, wave = queue[0][0], []
        while queue and queue[0][0] == now:
            wave.append(heapq.heappop(queue)[1])
        while wave:
            chosen: dict[int, int] = {}
            for p in wave:
                near = [labels[p + s] for s in around if labels[p + s]]
                if line and (len(set(near)) > 1 or any(chosen.get(p + s, near[0]) != near[0] for s in around)):
                    continue
                chosen[p] = near[0]
            for p, k in chosen.items():
                labels[p] = k
            wave = reach(list(chosen), now)
    out[:] = labels


#: A pixel's flooding: level and wave, and its label; label 0 is not flooded, or a line. Markers have wave -1.
EVENT = np.dtype([("level", "<f8"), ("wave", "<i4"), ("label", "<i8")])


def _ringed(a: np.ndarray) -> np.ndarray:
    return np.pad(a, ((2, 2), (1, 1)))


def flood_open(surface: np.ndarray, markers: np.ndarray, heard: dict[tuple[int, int], np.ndarray], mask: np.ndarray | None = None, line: bool = True, before: np.ndarray | None = None) -> np.ndarray:
    """``flood`` of a part of an image as ``EVENT`` of each pixel, given when the pixels around it were flooded.

    ``heard`` holds, for the sides (-1, 0), (1, 0), (0, -1), (0, 1), the events of the pixels beyond. Wave k of a level is what
    the level's wave k - 1 reached; markers are there before all. A pixel beyond takes part at its time like any other,
    but is not decided here.

    ``before`` is the result with other events around. Then only basins at the border flood anew, among the events of the others; where
    that changes what others have seen, they flood anew as well, until nothing that others see has changed.
    """
    h, w = surface.shape
    here = (slice(2, -2), slice(1, -1))
    state = np.zeros((h + 4, w + 2), EVENT)  # a row more above and below, so that what lies beyond has neighbours
    beyond = {(-1, 0): np.s_[1, 1:-1], (1, 0): np.s_[-2, 1:-1], (0, -1): np.s_[2:-2, 0], (0, 1): np.s_[2:-2, -1]}
    for side, events in heard.items():
        state[beyond[side]] = events
    open_ = _ringed(np.ones((h, w), bool) if mask is None else mask)
    marks = np.where(open_, _ringed(markers), 0)
    heights = _ringed(surface)
    if before is None:
        _flood_among(state, open_, heights, marks, line)
        return state[here]
    state[here] = before
    label = state["label"]
    ring = np.zeros_like(open_)
    ring[1:-1] = True
    ring[3:-3, 2:-2] = False
    again = np.zeros_like(open_)
    touched = ring
    while True:
        again |= _spread(np.isin(label, np.unique(label[touched])) & (label > 0) | touched) & open_
        new = state.copy()
        _flood_among(new, again, heights, marks, line)
        changed = new != state
        # pixels that flood anew, beside one that doesn't
        seen = changed & again & _spread(open_ & ~again)
        if not seen.any():
            return new[here]
        touched = _spread(_spread(seen)) & open_


def _spread(mask: np.ndarray) -> np.ndarray:
    """A mask with its neighbours across edges."""
    out = mask.copy()
    out[1:] |= mask[:-1]
    out[:-1] |= mask[1:]
    out[:, 1:] |= mask[:, :-1]
    out[:, :-1] |= mask[:, 1:]
    return out


def _flood_among(state: np.ndarray, open_: np.ndarray, heights: np.ndarray, marks: np.ndarray, line: bool) -> None:
    """Flood the open pixels in ``state``; the events of the others beside them stand."""
    wide = state.shape[1]
    beside = _spread(open_) & ~open_ & (state["label"] > 0)
    e_at = np.flatnonzero(beside)
    events = state.ravel()[e_at]
    inside = np.flatnonzero(open_)
    values, rank = np.unique(np.concatenate([heights.ravel()[inside], events["level"][events["wave"] >= 0]]), return_inverse=True)
    level = np.zeros(state.size, np.int64)
    level[inside] = rank[: len(inside)]
    out, done = np.where(open_, marks, 0).ravel(), (~open_ | (marks > 0)).ravel()
    first = events["wave"] < 0
    out[e_at[first]] = events["label"][first]
    e_at, e_wave, e_label, e_level = e_at[~first], events["wave"][~first], events["label"][~first], rank[len(inside) :]
    order = np.lexsort((e_wave, e_level))
    e_at, e_wave, e_label, e_level = e_at[order], e_wave[order], e_label[order], e_level[order]
    bounds = np.flatnonzero(np.r_[True, (e_level[1:] != e_level[:-1]) | (e_wave[1:] != e_wave[:-1]), True]) if len(e_at) else np.zeros(1, np.int64)
    groups = [(int(e_level[i]), int(e_wave[i]), i, j) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)][::-1]
    when, turn = np.zeros(len(out), np.int64), np.full(len(out), -1, np.int32)
    run = _waves_among if len(values) * 16 <= len(inside) else _pixels_among
    run(out, level, done, groups, e_at, e_label, np.array([-wide, -1, 1, wide]), when, turn, line)
    flat = state.reshape(-1)
    found = np.zeros(len(inside), EVENT)
    found["label"] = out[inside]
    on = found["label"] > 0
    found["wave"] = np.where(on, turn[inside], 0)
    found["level"] = np.where(on & (turn[inside] >= 0), values[when[inside]] if len(values) else 0, 0)
    flat[inside] = found


def _waves_among(out: np.ndarray, level: np.ndarray, done: np.ndarray, groups: list[tuple[int, int, int, int]], e_at: np.ndarray, e_label: np.ndarray, steps: np.ndarray, when: np.ndarray, turn: np.ndarray, line: bool) -> None:
    """Flood as arrays, wave by wave; ``groups`` are the events beyond by level and wave, the first last: level, wave and their places in ``e_at``."""
    waiting: dict[int, list[np.ndarray]] = {}
    turns = sorted({g[0] for g in groups})
    place = np.full(len(out), -1)

    def reach(kept: np.ndarray, now: int) -> np.ndarray:
        near = (kept[:, None] + steps).ravel()
        near = near[~done[near]]
        place[near] = np.arange(len(near))
        near = near[place[near] == np.arange(len(near))]  # each once
        place[near] = -1
        done[near] = True
        due = level[near] <= now
        later = near[~due]
        if len(later):
            sort = np.argsort(level[later], kind="stable")
            at, start = np.unique(level[later][sort], return_index=True)
            for k, part in zip(at.tolist(), np.split(later[sort], start[1:]), strict=True):
                if k not in waiting:
                    waiting[k] = []
                    heapq.heappush(turns, k)
                waiting[k].append(part)
        return near[due]

    reach(np.flatnonzero(out), -1)
    none = np.empty(0, np.int64)
    while turns:
        now = heapq.heappop(turns)
        if turns and turns[0] == now:
            continue
        wave, k = (np.concatenate(waiting.pop(now)) if now in waiting else none), 0
        while True:
            theirs = names = none
            if groups and groups[-1][0] == now:
                if not len(wave):
                    k = groups[-1][1]
                if groups[-1][1] == k:
                    _, _, i, j = groups.pop()
                    theirs, names = e_at[i:j], e_label[i:j]
            elif not len(wave):
                break
            when[wave], turn[wave] = now, k
            kept = _decided(out, place, wave, theirs, names, steps, line)
            wave, k = reach(np.concatenate([kept, theirs]) if len(theirs) else kept, now), k + 1


def _pixels_among(out: np.ndarray, level: np.ndarray, done: np.ndarray, groups: list[tuple[int, int, int, int]], e_at: np.ndarray, e_label: np.ndarray, steps: np.ndarray, when: np.ndarray, turn: np.ndarray, line: bool) -> None:
    """The same pixel by pixel, for surfaces with many values."""
    around = steps.tolist()
    up, left, right, down = around
    labels, heights, closed = out.tolist(), level.tolist(), done.tolist()
    queue: list[tuple[int, int]] = []

    def reach(kept: list[int], now: int) -> list[int]:
        due = []
        for p in kept:
            for s in around:
                q = p + s
                if not closed[q]:
                    closed[q] = True
                    if heights[q] <= now:
                        due.append(q)
                    else:
                        heapq.heappush(queue, (heights[q], q))
        due.sort()
        return due

    reach(np.flatnonzero(out).tolist(), -1)
    flooded: list[tuple[int, int, int]] = []
    while queue or groups:
        now = min(([queue[0][0]] if queue else []) + ([groups[-1][0]] if groups else []))
        wave, k = [], 0
        while queue and queue[0][0] == now:
            wave.append(heapq.heappop(queue)[1])
        while True:
            theirs: dict[int, int] = {}
            if groups and groups[-1][0] == now:
                if not wave:
                    k = groups[-1][1]
                if groups[-1][1] == k:
                    _, _, i, j = groups.pop()
                    theirs = dict(zip(e_at[i:j].tolist(), e_label[i:j].tolist(), strict=True))
            elif not wave:
                break
            chosen = dict(theirs)  # of rivals only those above and to the left come first
            kept = []
            for p in wave:
                a, b, c, d = labels[p + up], labels[p + left], labels[p + right], labels[p + down]
                own = a or b or c or d
                if line and (own != (b or own) or own != (c or own) or own != (d or own) or (chosen and (chosen.get(p + up, own) != own or chosen.get(p + left, own) != own))):
                    continue
                chosen[p] = own
                kept.append(p)
            for p, own in chosen.items():
                labels[p] = own
            flooded.extend((p, now, k) for p in kept)
            wave, k = reach([*kept, *theirs], now), k + 1
    out[:] = labels
    if flooded:
        at, levels, waves = np.array(flooded).T
        when[at], turn[at] = levels, waves


def _decided(out: np.ndarray, place: np.ndarray, wave: np.ndarray, theirs: np.ndarray, names: np.ndarray, steps: np.ndarray, line: bool) -> np.ndarray:
    """Label one wave, beside the pixels beyond that have their labels at the same time; returns what keeps one."""
    seen = out[wave[:, None] + steps]
    high = seen.max(axis=1, initial=0)
    if not line:
        out[wave] = seen[np.arange(len(wave)), np.argmax(seen > 0, axis=1)]
        out[theirs] = names
        return wave
    alive = ((seen == 0) | (seen == high[:, None])).all(axis=1)
    pixel, label = wave[alive], high[alive]
    n = len(pixel)
    if len(theirs):
        pixel, label = np.concatenate([pixel, theirs]), np.concatenate([label, names])
    place[pixel] = np.arange(len(pixel))
    other = place[pixel[:, None] + steps]
    place[pixel] = -1
    rival = (other >= 0) & (label[other] != label[:, None])
    state = np.ones(len(pixel), np.int8)  # 0 open, 1 kept, 2 line
    state[:n][rival[:n].any(axis=1)] = 0
    rival[:, 2:] = False  # of rivals only those above and to the left come first
    while True:
        open_ = np.flatnonzero(state == 0)
        if not len(open_):
            break
        before = np.where(rival[open_], state[other[open_]], 2)
        state[open_[(before == 1).any(axis=1)]] = 2
        state[open_[(before == 2).all(axis=1)]] = 1
    out[pixel[state == 1]] = label[state == 1]
    return pixel[:n][state[:n] == 1]


def column_distances(mask: np.ndarray, far: int) -> np.ndarray:
    """Squared distance of each pixel to the nearest member of its column; ``far`` where there is none."""
    y = np.arange(len(mask))[:, None]
    last = np.maximum.accumulate(np.where(mask, y, -(10**8)), axis=0)
    following = np.minimum.accumulate(np.where(mask, y, 10**8)[::-1], axis=0)[::-1]
    return np.minimum(np.minimum(y - last, following - y).astype(np.int64) ** 2, far)


def row_minima(g: np.ndarray) -> np.ndarray:
    """For each row and place x the least (x - k)**2 + g[k] over all places k.

    The least such k never falls as x grows. So places are settled from coarse to fine, each between its settled
    neighbours' k, all rows at once: log(width) steps over as many candidates as there are places, or twice that.
    """
    m, w = g.shape
    if not m or not w:
        return g.copy()
    at = np.zeros((m, w + 2), np.int64)  # place x stands in column x + 1
    at[:, w + 1] = w - 1
    step = 1 << w.bit_length()
    while step := step >> 1:
        x = np.arange(step, w + 1, 2 * step)
        if not len(x):
            continue
        low, high = at[:, x - step].ravel(), at[:, np.minimum(x + step, w + 1)].ravel()
        n = high - low + 1
        begin = np.cumsum(n) - n
        k = np.arange(n.sum()) + np.repeat(low - begin, n)
        row = np.repeat(np.repeat(np.arange(m), len(x)), n)
        cost = (np.repeat(np.tile(x - 1, m), n) - k) ** 2 + g[row, k]
        at[:, x] = (np.minimum.reduceat(cost * w + k, begin) % w).reshape(m, len(x))
    k = at[:, 1:-1]
    return (np.arange(w) - k) ** 2 + np.take_along_axis(g, k, axis=1)


def squared_distances(mask: np.ndarray) -> np.ndarray:
    """Exact squared distance of each pixel to the nearest member; far beyond the image where there is none."""
    h, w = mask.shape
    return row_minima(column_distances(mask, 4 * (h + w) ** 2))


def hull_area(y: np.ndarray, x: np.ndarray) -> float:
    """Area of the convex hull of the pixels' squares."""
    points = np.unique(np.concatenate([np.stack([y + dy, x + dx], axis=1) for dy in (0, 1) for dx in (0, 1)]), axis=0).tolist()

    def half(ps: list) -> list:
        out: list = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out

    ring = np.array(half(points)[:-1] + half(points[::-1])[:-1], float)
    a, b = ring[:, 0], ring[:, 1]
    return float(abs((a * np.roll(b, -1) - b * np.roll(a, -1)).sum()) / 2)
