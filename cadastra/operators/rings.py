"""Repair of polygon rings that touch, overlap or cross themselves.

An area is what lies inside an odd number of its rings (the rule of
``spatial.point_in_rings``).  Borders are cut wherever they meet; a piece that
runs an even number of times has the same side twice and vanishes.  What is left
divides the plane into faces.  Each face is walked with its area to the left, is
kept if a point inside it, beside its steepest edge, lies in an odd number of
rings, and is parted where the walk comes back to a corner.  Outer rings then run
counter-clockwise and holes clockwise by themselves, and rings only touch in
corners.  All of it is numpy over many shapes at a time, in Arrow batches: small
shapes are arranged together, a shape of many edges by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Points closer than this share of a shape's extent are one.
TOLERANCE = 1e-9
#: Edge pairs looked at in one go.
PAIRS = 1_000_000
AS_IS, REPAIRED, BROKEN = 0, 1, 2


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _portions(count: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of entries that stand for at most ``PAIRS`` pairs together, one entry at least."""
    total, begin = np.cumsum(count), 0
    while begin < len(count):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + PAIRS)))
        yield begin, min(end, len(count))
        begin = end


def close_pairs(edges: np.ndarray, slack: np.ndarray, shape: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of edges of one shape whose boxes touch, by a sweep over x, in bounded portions."""
    low = np.minimum(edges[:, :2], edges[:, 2:]) - slack[:, None]
    high = np.maximum(edges[:, :2], edges[:, 2:]) + slack[:, None]
    order = np.lexsort((low[:, 0], shape))
    low, high, of = low[order], high[order], shape[order]
    # How many edges of the shape begin up to where an edge ends: both kinds of ends in one order.
    n = len(edges)
    ends = np.lexsort((np.repeat([0, 1], n), np.concatenate([low[:, 0], high[:, 0]]), np.tile(of, 2)))
    begun = np.empty(2 * n, dtype=int)
    begun[ends] = np.cumsum(ends < n)
    count = begun[n:] - np.arange(n) - 1
    for begin, end in _portions(count):
        a = np.repeat(np.arange(begin, end), count[begin:end])
        b = a + 1 + _counted(count[begin:end])
        meet = (low[a, 1] <= high[b, 1]) & (low[b, 1] <= high[a, 1])
        yield order[a[meet]], order[b[meet]]


def contacts(edges: np.ndarray, slack_of: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edge, share along it and point of every place where an edge meets another one of its shape, ends included."""
    where, shares, points = [], [], []

    def add(edge: np.ndarray, share: np.ndarray, point: np.ndarray) -> None:
        where.append(edge)
        shares.append(share)
        points.append(point)

    for i, j in close_pairs(edges, slack_of, shape):
        slack = slack_of[i]
        p, q = edges[i, :2], edges[j, :2]
        r, s = edges[i, 2:] - p, edges[j, 2:] - q
        w, cross = q - p, r[:, 0] * s[:, 1] - r[:, 1] * s[:, 0]
        long_r, long_s = np.hypot(*r.T), np.hypot(*s.T)
        flat = np.abs(cross) <= 1e-12 * long_r * long_s
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (w[:, 0] * s[:, 1] - w[:, 1] * s[:, 0]) / cross
            u = (w[:, 0] * r[:, 1] - w[:, 1] * r[:, 0]) / cross
        meets = ~flat & (t >= -slack / long_r) & (t <= 1 + slack / long_r) & (u >= -slack / long_s) & (u <= 1 + slack / long_s)
        at = p[meets] + r[meets] * t[meets, None]
        add(i[meets], t[meets], at)
        add(j[meets], u[meets], at)
        # Parallel edges, and ends that lie on an edge: the end itself is the point.
        for own, base, along, length, other in ((i, p, r, long_r, j), (j, q, s, long_s, i)):
            for end in (edges[other, :2], edges[other, 2:]):
                gap = end - base
                share = (gap * along).sum(axis=1) / length**2
                off = np.abs(gap[:, 0] * along[:, 1] - gap[:, 1] * along[:, 0]) / length
                on = (off <= slack) & (share * length >= -slack) & ((share - 1) * length <= slack)
                add(own[on], share[on], end[on])
    return np.concatenate([*where, np.empty(0, int)]), np.concatenate([*shares, np.empty(0)]), np.concatenate([*points, np.empty((0, 2))])


def _numbered(*keys: np.ndarray) -> np.ndarray:
    """A number from 0 for every row; equal rows get the same."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    out = np.empty(len(order), dtype=int)
    out[order] = np.cumsum(new)
    return out


def merged(points: np.ndarray, slack: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """A number for every point; points of a shape within ``slack`` of each other get the same."""
    label = np.arange(len(points))
    places = points / (2 * slack[:, None])
    cells = [_numbered(*np.floor(places + np.array(shift) / 2).T, shape) for shift in np.ndindex(2, 2)]
    while True:
        before = label
        for cell in cells:
            least = np.full(cell.max(initial=-1) + 1, len(points))
            np.minimum.at(least, cell, label)
            label = least[cell]
        if np.array_equal(label, before):
            return label


def _walks(origin: np.ndarray, target: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The half-edges around each face, its area to the left, one face after the other, and the number of each.

    Half-edge ``k`` and ``k ^ 1`` are one edge.
    """
    angle = np.arctan2(*(at[target] - at[origin]).T[::-1])
    order = np.lexsort((angle, origin))
    place = np.empty(len(order), dtype=int)
    place[order] = np.arange(len(order))
    first = np.searchsorted(origin[order], np.arange(len(at)))
    last = np.searchsorted(origin[order], np.arange(len(at)), "right") - 1
    back = np.arange(len(order)) ^ 1
    corner = origin[back]
    following = order[np.where(place[back] == first[corner], last[corner], place[back] - 1)].tolist()
    done = [False] * len(following)
    walks, sizes = [], []
    for start in range(len(following)):
        if not done[start]:
            before, h = len(walks), start
            while not done[h]:
                done[h] = True
                walks.append(h)
                h = following[h]
            sizes.append(len(walks) - before)
    return np.array(walks, dtype=int), np.array(sizes, dtype=int)


def _parted(corners: list[int]) -> Iterator[list[int]]:
    """A closed walk as simple rings: it is cut where it returns to a corner."""
    path, place = [], {}
    for corner in corners:
        if corner in place:
            cut = place[corner]
            yield path[cut:]
            for gone in path[cut + 1 :]:
                del place[gone]
            del path[cut + 1 :]
        else:
            place[corner] = len(path)
            path.append(corner)
    yield path


def signed_area(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T
    return float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2


def _no_area(rings: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of the rings, given one after the other, have a signed area of zero."""
    start = np.cumsum(sizes) - sizes
    x, y = (rings - np.repeat(rings[start], sizes, axis=0)).T
    onward = np.arange(len(rings)) + 1
    onward[start + sizes - 1] = start
    return np.add.reduceat(x * y[onward], start) == np.add.reduceat(y * x[onward], start)


def arranged(points: np.ndarray, rings: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Repaired rings of many shapes in their order: points, points of each ring, shape of each ring, and what became of each shape.

    Given are the corners of open rings one after the other, the corners of each
    ring and the rings of each shape.  A shape is ``AS_IS`` where its rings only
    meet in their own corners, and ``BROKEN`` if a coordinate is not finite or no
    area is left; both give no rings.
    """
    n_shapes = len(shapes)
    kind = np.full(n_shapes, BROKEN)
    nothing = np.empty((0, 2)), np.empty(0, int), np.empty(0, int), kind
    of_ring = np.repeat(np.arange(n_shapes), shapes)
    shape = np.repeat(of_ring, rings)
    finite = np.bincount(shape, ~np.isfinite(points).all(axis=1), minlength=n_shapes) == 0
    # Every corner with the next one of its ring.
    onward = np.arange(len(points)) + 1
    some = rings > 0
    onward[np.cumsum(rings)[some] - 1] = (np.cumsum(rings) - rings)[some]
    low, high = np.full((n_shapes, 2), np.inf), np.full((n_shapes, 2), -np.inf)
    sound = finite[shape]
    np.minimum.at(low, shape[sound], points[sound])
    np.maximum.at(high, shape[sound], points[sound])
    with np.errstate(invalid="ignore"):
        slack = TOLERANCE * np.maximum((high - low).max(axis=1), 1e-300)
    edges, shape = np.hstack([points, points[onward]])[sound], shape[sound]
    long = np.hypot(*(edges[:, 2:] - edges[:, :2]).T) > slack[shape]
    edges, shape = edges[long], shape[long]
    n = len(edges)
    if not n:
        return nothing
    where, share, point = contacts(edges, slack[shape], shape)
    ends = np.concatenate([edges[:, :2], edges[:, 2:], point])
    of_end = np.concatenate([shape, shape, shape[where]])
    label = merged(ends, slack[of_end], of_end)
    edge = np.concatenate([np.arange(n), np.arange(n), where])
    share = np.concatenate([np.zeros(n), np.ones(n), share])
    order = np.lexsort((share, edge))
    edge, label = edge[order], label[order]
    step = (edge[1:] == edge[:-1]) & (label[1:] != label[:-1])
    a, b = label[:-1][step], label[1:][step]
    # Of ends that became one corner, and of equal pieces, an even number vanishes.
    less, more = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((more, less, of_end[less]))
    less, more = less[order], more[order]
    new = np.ones(len(less), dtype=bool)
    new[1:] = (np.diff(less) != 0) | (np.diff(more) != 0)
    times = np.diff(np.append(np.flatnonzero(new), len(less)))
    less, more = less[new], more[new]
    of_piece = of_end[less]
    corner, visits = np.unique(np.concatenate([a, b]), return_counts=True)
    as_is = np.bincount(of_piece, times != 1, minlength=n_shapes) == 0
    as_is &= np.bincount(of_end[corner], visits != 2, minlength=n_shapes) == 0
    as_is &= np.bincount(of_end[a], minlength=n_shapes) == np.bincount(shape, minlength=n_shapes)
    as_is &= np.bincount(shape, minlength=n_shapes) > 0
    kind[as_is] = AS_IS
    left = (times % 2 == 1) & ~as_is[of_piece]
    # A border that does not close leaves a corner with an odd number of pieces.
    corner, pieces = np.unique(np.concatenate([less[left], more[left]]), return_counts=True)
    left &= (np.bincount(of_end[corner], pieces % 2, minlength=n_shapes) == 0)[of_piece]
    if not left.any():
        return nothing
    used, dense = np.unique(np.stack([less[left], more[left]]), return_inverse=True)
    at, (u, v), of_piece = ends[used], dense.reshape(2, -1), of_piece[left]
    origin, target = np.stack([u, v], axis=1).ravel(), np.stack([v, u], axis=1).ravel()
    walks, sizes = _walks(origin, target, at)
    kept = _inside(walks, sizes, origin, target, at, of_piece)
    out, out_sizes, out_shapes = [], [], []
    corners, begin = origin[walks].tolist(), np.cumsum(sizes) - sizes
    for face in np.flatnonzero(kept):
        for ring in _parted(corners[begin[face] : begin[face] + sizes[face]]):
            if len(ring) >= 3:
                out += ring
                out_sizes.append(len(ring))
                out_shapes.append(of_piece[walks[begin[face]] >> 1])
    if not out:
        return nothing
    found, sizes, owner = at[np.array(out)], np.array(out_sizes), np.array(out_shapes)
    real = ~_no_area(found, sizes)
    kind[owner[real]] = REPAIRED
    return found[np.repeat(real, sizes)], sizes[real], owner[real], kind


def _inside(walks: np.ndarray, sizes: np.ndarray, origin: np.ndarray, target: np.ndarray, at: np.ndarray, of_piece: np.ndarray) -> np.ndarray:
    """Which faces lie in an odd number of rings: an even number of borders is crossed from beside their steepest edge otherwise."""
    begin = np.cumsum(sizes) - sizes
    rise = np.abs(at[target[walks], 1] - at[origin[walks], 1])
    top = np.flatnonzero(rise == np.repeat(np.maximum.reduceat(rise, begin), sizes))
    face = np.repeat(np.arange(len(sizes)), sizes)
    steepest = walks[top[np.searchsorted(face[top], np.arange(len(sizes)))]]
    o, t = at[origin[steepest]], at[target[steepest]]
    middle = (o + t) / 2
    y0, y1 = at[origin[::2], 1], at[target[::2], 1]
    x0, x1 = at[origin[::2], 0], at[target[::2], 0]
    # The pieces of a shape stand together.
    shape = of_piece[steepest >> 1]
    first = np.searchsorted(of_piece, shape)
    many = np.searchsorted(of_piece, shape, "right") - first
    crossed = np.zeros(len(sizes), dtype=int)
    for one, end in _portions(many):
        f = np.repeat(np.arange(one, end), many[one:end])
        k = first[f] + _counted(many[one:end])
        spans = ((y0[k] > middle[f, 1]) != (y1[k] > middle[f, 1])) & (k != steepest[f] >> 1)
        f, k = f[spans], k[spans]
        x = x0[k] + (middle[f, 1] - y0[k]) * (x1[k] - x0[k]) / (y1[k] - y0[k])
        crossed += np.bincount(f, x > middle[f, 0], minlength=len(sizes)).astype(int)
    right = crossed % 2 == 1  # just right of the edge; across it is the opposite
    return right == (t[:, 1] < o[:, 1])


def arrange(rings: list[np.ndarray]) -> list[np.ndarray] | None:
    """Open rings whose area is that of the given open rings, or ``None`` where these only meet in their own corners.

    Fails if a coordinate is not finite or no area is left.
    """
    points, sizes, _, kind = arranged(np.concatenate(rings), np.array([len(r) for r in rings]), np.array([len(rings)]))
    if kind[0] == BROKEN:
        raise ValueError("a coordinate is not finite" if not np.isfinite(np.concatenate(rings)).all() else "no area")
    return None if kind[0] == AS_IS else np.split(points, np.cumsum(sizes)[:-1])


def repaired_batch(points: np.ndarray, rings: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``arranged``, a bounded number of edge pairs at a time; the result of a shape does not depend on its neighbours."""
    last_ring, last_point = np.append(0, np.cumsum(shapes)), np.append(0, np.cumsum(rings))
    corners = np.diff(last_point[last_ring])
    parts = []
    for begin, end in _portions(corners * corners):
        r = slice(last_ring[begin], last_ring[end])
        p = slice(last_point[r.start], last_point[r.stop])
        found, sizes, owner, kind = arranged(points[p], rings[r], shapes[begin:end])
        parts.append((found, sizes, owner + begin, kind))
    if not parts:
        return np.empty((0, 2)), np.empty(0, int), np.empty(0, int), np.empty(0, int)
    return tuple(np.concatenate(part) for part in zip(*parts, strict=True))


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)).astype("int32"))


def _lists(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the lists (0 for a missing one) and their values one after the other."""
    a = a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a
    return np.asarray(a.value_lengths().fill_null(0)).astype(int), np.asarray(a.flatten())


def subdivided(rings: Column, plain: Column) -> Column:
    """``xs, ys, kind`` of closed rings: coordinates of their repaired form; shapes known to be ``plain`` are left out."""

    @F.arrow_udf("xs array<array<double>>, ys array<array<double>>, kind int")
    def repair(numbers: pa.Array, sizes: pa.Array) -> pa.Array:
        shapes, closed = _lists(sizes)
        points = _lists(numbers)[1].reshape(-1, 2)
        # Without the last point of each ring, which is its first.
        open_ = np.ones(len(points), dtype=bool)
        open_[np.cumsum(closed) - 1] = False
        found, n, owner, kind = repaired_batch(points[open_], closed - 1, shapes)
        kind[~np.asarray(sizes.is_valid())] = AS_IS
        # Closed again: every ring begins with the point it ends with.
        first = np.cumsum(n) - n
        at = np.insert(np.arange(len(found)), np.cumsum(n), first)
        each, whole = _offsets(np.bincount(owner, minlength=len(shapes))), _offsets(n + 1)
        xs, ys = (pa.ListArray.from_arrays(each, pa.ListArray.from_arrays(whole, pa.array(c))) for c in found[at].T)
        return pa.StructArray.from_arrays([xs, ys, pa.array(kind.astype("int32"))], ["xs", "ys", "kind"])

    flat = F.flatten(F.transform(F.flatten(rings), lambda p: F.array(p["x"], p["y"])))
    counts = F.transform(rings, lambda r: F.size(r))
    return repair.asNondeterministic()(F.when(~plain, flat), F.when(~plain, counts))


def from_coordinates(xs: Column, ys: Column) -> Column:
    """Rings of the coordinates of each ring."""
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.zip_with(xs, ys, lambda x, y: F.zip_with(x, y, point))
