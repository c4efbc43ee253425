"""Union and overlay of polygons with holes, cell by cell of a grid.

A polygon goes to the cells that its box touches, cut to a little more than the cell; what a group holds is therefore one cell's. Inside a cell
coverage is exact, so no piece has to be stitched: an edge belongs to the cell that its middle lies in (the west and south borders included), and
it is part of the union's outline if exactly one of its sides is covered. Areas are sums over slabs between all corners and crossings, within
which edges do not meet. A cell that many polygons share is quartered inside its task until few differ in a part; a part that one of them covers whole is done.

Overlaps of pairs: a polygon becomes signed sides once (``many_sides``), and the area that two share is a sum over pairs of sides, taken for many pairs at once.
Upright sides that come in pairs are signed boxes, of which each block is taken with each other. Polygons of a cell are filed in blocks of bounded size, and a pair is
looked at in the one cell that holds the lower corner of what its boxes share; within a cell boxes are parted for as long as that leaves fewer pairs to look at.

Polygons are rings, the outer one first or not: a point is inside if it lies in an odd number of them. Rings of fewer than three corners are
none; null rings are left out; a polygon without rings covers nothing; equal polygons count once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Ring = np.ndarray  # (corners, 2)
SHAPE = "area double, outline array<struct<x1:double,y1:double,x2:double,y2:double>>"


def cut_ring(ring: Ring, box: tuple[float, float, float, float]) -> Ring:
    """A ring cut to a box (minx, miny, maxx, maxy), one half-plane after the other."""
    for axis, bound, sign in ((0, box[0], 1), (1, box[1], 1), (0, box[2], -1), (1, box[3], -1)):
        if not len(ring):
            break
        d = sign * (ring[:, axis] - bound)
        nxt, dn = np.roll(ring, -1, 0), np.roll(d, -1)
        out = []
        for p, q, a, b in zip(ring, nxt, d, dn, strict=True):
            if a >= 0:
                out.append(p)
            if (a < 0) != (b < 0):
                out.append(p + (q - p) * (a / (a - b)))
        ring = np.array(out).reshape(-1, 2)
    return ring


def edges_of(rings: Sequence[Ring]) -> np.ndarray:
    """(edges, 4) of closed rings, without those of no length."""
    parts = [np.concatenate([r, np.roll(r, -1, 0)], 1) for r in rings if len(r) > 2]
    e = np.concatenate(parts) if parts else np.zeros((0, 4))
    return e[(e[:, :2] != e[:, 2:]).any(1)]


def covered(points: np.ndarray, polygons: Sequence[np.ndarray]) -> np.ndarray:
    """Whether points lie in any of the polygons, given by their edges."""
    x, y = points[:, :1], points[:, 1:]
    out = np.zeros(len(points), bool)
    for e in polygons:
        x1, y1, x2, y2 = e.T
        spans = (y1 > y) != (y2 > y)
        at = x1 + (y - y1) * (x2 - x1) / np.where(y2 == y1, 1.0, y2 - y1)
        out |= (spans & (x < at)).sum(1) % 2 == 1
    return out


def crossings(e: np.ndarray) -> list[np.ndarray]:
    """For each edge the places (0 to 1) at which others meet it, its ends included."""
    p, d = e[:, :2], e[:, 2:] - e[:, :2]
    cross = lambda a, b: a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]
    out = []
    for i in range(len(e)):
        to, det = p - p[i], cross(d[i], d)
        flat = np.abs(det) < 1e-12 * np.hypot(*d[i]) * np.hypot(d[:, 0], d[:, 1])
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = cross(to, d) / det, cross(to, d[i]) / det
        met = t[~flat & (u >= -1e-12) & (u <= 1 + 1e-12)]
        # Edges on one line meet at their ends.
        on = flat & (np.abs(cross(to, d[i])) < 1e-12 * np.dot(d[i], d[i]))
        ends = np.concatenate([(p[on] - p[i]) @ d[i], (e[on, 2:] - p[i]) @ d[i]]) / np.dot(d[i], d[i])
        ts = np.concatenate([[0.0, 1.0], met, ends])
        out.append(np.unique(np.round(ts[(ts >= 0) & (ts <= 1)], 12)))
    return out


def cell_outline(polygons: Sequence[np.ndarray], box: tuple[float, float, float, float]) -> np.ndarray:
    """(segments, 4) of the union's outline in a cell."""
    e = np.concatenate(polygons) if polygons else np.zeros((0, 4))
    found = []
    minx, miny, maxx, maxy = box
    for (x1, y1, x2, y2), ts in zip(e, crossings(e), strict=True):
        # The cell's borders part an edge too.
        more = [(b - a) / d for a, d, bs in ((x1, x2 - x1, (minx, maxx)), (y1, y2 - y1, (miny, maxy))) if d for b in bs]
        ts = np.unique(np.r_[ts, [t for t in more if 0 < t < 1]])
        a, b = ts[:-1, None], ts[1:, None]
        start, end = np.array([x1, y1]), np.array([x2, y2])
        found.append(np.concatenate([start + (end - start) * a, start + (end - start) * b], 1))
    if not found:
        return np.zeros((0, 4))
    s = np.concatenate(found)
    middle = (s[:, :2] + s[:, 2:]) / 2
    s = s[(middle[:, 0] >= minx) & (middle[:, 0] < maxx) & (middle[:, 1] >= miny) & (middle[:, 1] < maxy)]
    swap = (s[:, 0] > s[:, 2]) | (s[:, 0] == s[:, 2]) & (s[:, 1] > s[:, 3])
    s[swap] = s[swap][:, [2, 3, 0, 1]]
    scale = max(maxx - minx, maxy - miny)
    s = s[np.unique(np.round(s / scale, 10), axis=0, return_index=True)[1]]
    s = s[np.hypot(s[:, 2] - s[:, 0], s[:, 3] - s[:, 1]) > 1e-10 * scale]
    normal = np.stack([s[:, 1] - s[:, 3], s[:, 2] - s[:, 0]], 1)
    normal *= 1e-7 * scale / np.maximum(np.hypot(normal[:, 0], normal[:, 1]), 1e-300)[:, None]
    middle = (s[:, :2] + s[:, 2:]) / 2
    return s[covered(middle + normal, polygons) != covered(middle - normal, polygons)]


def cell_area(groups: Sequence[Sequence[np.ndarray]], box: tuple[float, float, float, float]) -> float:
    """The area in a cell that each of the groups covers with any of its polygons: of one group its union, of two their overlap."""
    minx, miny, maxx, maxy = box
    all_ = [e for g in groups for e in g]
    if not all_ or not all(groups):
        return 0.0
    e = np.concatenate(all_)
    ys = np.concatenate([y1 + (y2 - y1) * ts for (_, y1, _, y2), ts in zip(e, crossings(e), strict=True)])
    # Where an edge leaves the cell sideways its part of a slab ends.
    with np.errstate(divide="ignore", invalid="ignore"):
        sides = [e[:, 1] + (x - e[:, 0]) * (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0]) for x in (minx, maxx)]
    ys = np.concatenate([ys, *sides, [miny, maxy]])
    ys = np.unique(ys[np.isfinite(ys) & (ys >= miny) & (ys <= maxy)])
    total = 0.0
    for low, high in zip(ys[:-1], ys[1:], strict=True):
        y, now = (low + high) / 2, None
        for group in groups:
            spans = []
            for g in group:
                x1, y1, x2, y2 = g[(g[:, 1] > y) != (g[:, 3] > y)].T
                xs = np.clip(np.sort(x1 + (y - y1) * (x2 - x1) / (y2 - y1)), minx, maxx)
                spans += list(zip(xs[::2], xs[1::2], strict=True))
            own = _joined(spans)
            now = own if now is None else _common(now, own)
        total += sum(b - a for a, b in now) * (high - low)
    return float(total)


def _joined(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _common(one: list[tuple[float, float]], other: list[tuple[float, float]]) -> list[tuple[float, float]]:
    return [(max(a, c), min(b, d)) for a, b in one for c, d in other if max(a, c) < min(b, d)]


FEW, DEEPEST = 4, 8


def clamped(e: np.ndarray, own: np.ndarray, box: tuple[float, float, float, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges of closed polygons moved onto a box (edges, whose they are, whether they run along its border): cut at its four lines and clamped, so that
    inside the box each polygon is what it was."""
    low, high = np.array(box[:2]), np.array(box[2:])
    p, d = e[:, :2], e[:, 2:] - e[:, :2]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.concatenate([(low - p) / d, (high - p) / d], 1)
    t = np.sort(np.where((t > 0) & (t < 1), t, 0.0), 1)
    t = np.concatenate([t, np.ones((len(e), 1))], 1)
    at = p[:, None, :] + d[:, None, :] * t[:, :, None]
    at[:, -1] = e[:, 2:]  # the end itself
    at = np.clip(np.concatenate([np.clip(p, low, high)[:, None, :], at], 1), low, high)
    out = np.concatenate([at[:, :-1], at[:, 1:]], 2).reshape(-1, 4)
    kept = (out[:, :2] != out[:, 2:]).any(1)
    out = out[kept]
    along = ((out[:, :2] == out[:, 2:]) & ((out[:, :2] == low) | (out[:, :2] == high))).any(1)
    return out, np.repeat(own, 5)[kept], along


def parted(e: np.ndarray, own: np.ndarray, box: tuple[float, float, float, float], depth: int = 0) -> Iterator[tuple[tuple[float, float, float, float], list[np.ndarray] | None]]:
    """A cell in parts (box, polygons): None where one polygon covers the part and a rim around it, nothing where none is. Polygons that are equal in a part count once there."""
    minx, miny, maxx, maxy = box
    rim = max(maxx - minx, maxy - miny) / 64
    e, own, along = clamped(e, own, (minx - rim, miny - rim, maxx + rim, maxy + rim))
    if not len(e):
        return
    names, own = np.unique(own, return_inverse=True)
    inside = np.bincount(own, ~along, len(names)) > 0
    # What has no edge inside covers all of it or nothing.
    x1, y1, x2, y2 = e.T
    x, y = (minx + maxx) / 2, (miny + maxy) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        right = ((y1 > y) != (y2 > y)) & (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1))
    if ((np.bincount(own, right, len(names)) % 2 == 1) & ~inside).any():
        yield box, None
        return
    e, own = e[inside[own]], own[inside[own]]
    if not len(e):
        return
    swap = (e[:, 0] > e[:, 2]) | (e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3])
    e[swap] = e[swap][:, [2, 3, 0, 1]]
    order = np.lexsort((*e.T[::-1], own))
    e, own = e[order], own[order]
    differing = list({x.tobytes(): x for x in np.split(e, np.flatnonzero(np.diff(own)) + 1)}.values())
    if len(differing) <= FEW or depth == DEEPEST:
        yield box, differing
        return
    e, own = np.concatenate(differing), np.repeat(np.arange(len(differing)), [len(x) for x in differing])
    for x0, x1 in ((minx, x), (x, maxx)):
        for y0, y1 in ((miny, y), (y, maxy)):
            yield from parted(e, own, (x0, y0, x1, y1), depth + 1)


def cell_union(polygons: Sequence[np.ndarray], box: tuple[float, float, float, float]) -> tuple[float, np.ndarray]:
    """The area and the outline's (segments, 4) of a cell's union, part by part."""
    area, lines = 0.0, [np.zeros((0, 4))]
    if polygons:
        for part, found in parted(np.concatenate(polygons), np.repeat(np.arange(len(polygons)), [len(e) for e in polygons]), box):
            if found is None:
                area += (part[2] - part[0]) * (part[3] - part[1])
            else:
                area += cell_area([found], part)
                lines.append(cell_outline(found, part))
    return area, np.concatenate(lines)


def in_cells(polygons: DataFrame, keys: Sequence[str], side: float, rings: str = "rings") -> DataFrame:
    """(keys, cx, cy, rings): each polygon (rings: array of rings of (x, y)) in the cells of a grid of ``side`` that its box touches."""
    corners = F.flatten(F.transform(F.filter(rings, lambda r: r.isNotNull()), lambda r: r))
    p = polygons.select(*keys, F.col(rings).alias("rings"), F.transform(corners, lambda c: c[0]).alias("_x"), F.transform(corners, lambda c: c[1]).alias("_y"))
    steps = lambda c: F.explode(F.sequence(F.ceil(F.array_min(c) / side).cast("long") - 1, F.floor(F.array_max(c) / side).cast("long")))
    return p.where(F.size("_x") > 2).select(*keys, "rings", "_y", steps(F.col("_x")).alias("cx")).select(*keys, "rings", "cx", steps(F.col("_y")).alias("cy"))


SHORT = 64


def _read(rows: pd.Series, cx: int, cy: int, side: float) -> tuple[list[np.ndarray], tuple[float, float, float, float]]:
    box = cx * side, cy * side, (cx + 1) * side, (cy + 1) * side
    near = box[0] - side / 64, box[1] - side / 64, box[2] + side / 64, box[3] + side / 64
    out = []
    for rings in rows:
        known = (np.array([list(p) for p in r], float) for r in rings if r is not None and len(r) > 2)
        # Short rings stay as they are: what lies beyond the cell is cut from them later, for many at once.
        e = edges_of([r if len(r) <= SHORT else cut_ring(r, near) for r in known])
        if len(e):
            out.append(e)
    return out, box


def union(polygons: DataFrame, keys: Sequence[str], side: float, rings: str = "rings") -> DataFrame:
    """(keys, cx, cy, area, outline): the union of the polygons of a key, by cells. Sums of areas and of lengths are the union's; holes are part of the outline."""
    kinds = dict(polygons.dtypes)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        found, box = _read(pdf["rings"], int(first["cx"]), int(first["cy"]), side)
        area, lines = cell_union(found, box)
        outline = [dict(zip(("x1", "y1", "x2", "y2"), map(float, s), strict=True)) for s in lines]
        return pd.DataFrame({**{k: [first[k]] for k in keys}, "cx": [first["cx"]], "cy": [first["cy"]], "area": [area], "outline": [outline]})

    cells = in_cells(polygons, keys, side, rings).distinct()
    return cells.groupBy(*keys, "cx", "cy").applyInPandas(one, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "cx long, cy long", SHAPE]))


def sides(rings: Sequence[Ring]) -> np.ndarray:
    """(sides, 5) of a polygon (x1, y1, x2, y2 with y1 < y2, sign): the signs of the sides to the left of a point add up to one inside and to nothing outside."""
    return _sides(edges_of(rings))


def _sides(e: np.ndarray) -> np.ndarray:
    e = e[e[:, 1] != e[:, 3]]
    if not len(e):
        return np.zeros((0, 5))
    e = np.where((e[:, 1] > e[:, 3])[:, None], e[:, [2, 3, 0, 1]], e)
    met = [y1 + (y2 - y1) * t[(t > 0) & (t < 1)] for (_, y1, _, y2), t in zip(e, crossings(e), strict=True)]
    ys = np.unique(np.concatenate([e[:, 1], e[:, 3], *met]))
    found: list[list[float]] = []
    last: dict[int, int] = {}
    slope = (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1])
    for low, high in zip(ys[:-1], ys[1:], strict=True):
        y = (low + high) / 2
        live = np.flatnonzero((e[:, 1] < y) & (e[:, 3] > y))
        at = e[live, 0] + (y - e[live, 1]) * slope[live]
        for n, k in enumerate(live[np.argsort(at, kind="stable")].tolist()):
            sign = -1.0 if n % 2 else 1.0
            if k in last and found[last[k]][2] == low and found[last[k]][3] == sign:
                found[last[k]][2] = high
            else:
                last[k] = len(found)
                found.append([k, low, high, sign])
    k, low, high, sign = np.array(found).T
    k = k.astype(int)
    x1 = np.where(low == e[k, 1], e[k, 0], e[k, 0] + (low - e[k, 1]) * slope[k])
    x2 = np.where(high == e[k, 3], e[k, 2], e[k, 0] + (high - e[k, 1]) * slope[k])
    return np.stack([x1, low, x2, high, sign], 1)


CALL = 1 << 19  # pairs of sides looked at together


def _slab_sides(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sides, whose they are, polygons whose edges cross) of polygons of the same number of edges: (polygons, edges, 4), y1 < y2."""
    x1, y1, x2, y2 = np.moveaxis(e, -1, 0)
    ys = np.sort(np.concatenate([y1, y2], 1), 1)
    ys[:, 1:][ys[:, 1:] == ys[:, :-1]] = np.inf
    ys.sort(1)
    low, high = ys[:, :-1], ys[:, 1:]
    slope = (x2 - x1) / (y2 - y1)
    with np.errstate(invalid="ignore"):
        mid = (low + high)[:, :, None] / 2
        live = (y1[:, None] < mid) & (y2[:, None] > mid)
        at = lambda y: np.where(live, np.where(y == y1[:, None], x1[:, None], np.where(y == y2[:, None], x2[:, None], x1[:, None] + (y - y1[:, None]) * slope[:, None])), np.inf)
        order = np.argsort(at(mid), axis=2, kind="stable")
        crossed = np.zeros(len(e), bool)
        for y in (low, high):
            crossed |= (np.diff(np.take_along_axis(at(y[:, :, None]), order, 2), axis=2) < 0).any((1, 2))
    sign = np.where(np.arange(e.shape[1]) % 2, -1, 1) * np.ones(order.shape, int)
    out = np.empty_like(sign)
    np.put_along_axis(out, order, sign, 2)
    # Along an edge, the runs of slabs in which it has the same sign.
    run = np.where(live, out, 0).transpose(0, 2, 1)
    run[crossed] = 0
    edge = np.pad(run, ((0, 0), (0, 0), (1, 1)))
    i, k, first = np.nonzero((run != 0) & (run != edge[:, :, :-2]))
    last = np.nonzero((run != 0) & (run != edge[:, :, 2:]))[2]
    a, b = low[i, first], high[i, last]
    x1, y1, x2, y2, slope = (v[i, k] for v in (x1, y1, x2, y2, slope))
    return np.stack([np.where(a == y1, x1, x1 + (a - y1) * slope), a, np.where(b == y2, x2, x1 + (b - y1) * slope), b, run[i, k, first]], 1), i, np.flatnonzero(crossed)


def many_sides(e: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sides, whose they are) of many polygons, as ``sides`` gives them for one: (edges, 4) and whose they are, in order."""
    steep = e[:, 1] != e[:, 3]
    e, own = e[steep], own[steep]
    e = np.where((e[:, 1] > e[:, 3])[:, None], e[:, [2, 3, 0, 1]], e)
    names, start, n = np.unique(own, return_index=True, return_counts=True)
    found, whose = [np.zeros((0, 5))], [np.zeros(0, int)]
    for k in np.unique(n).tolist():
        alike = np.flatnonzero(n == k)
        step = max(1, CALL // (2 * k * k))
        for part in (alike[f : f + step] for f in range(0, len(alike), step)):
            alone = np.arange(len(part))
            if k <= SHORT:
                s, i, alone = _slab_sides(e[start[part, None] + np.arange(k)])
                found.append(s)
                whose.append(names[part[i]])
            for i in alone.tolist():
                s = _sides(e[start[part[i]] : start[part[i]] + k])
                found.append(s)
                whose.append(np.full(len(s), names[part[i]]))
    return np.concatenate(found), np.concatenate(whose)


def in_pairs(s: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sides, whose they are, which of the n polygons are in pairs): sides by polygon; if all of a polygon's are upright and each has one of the other sign and the same heights, these follow each other."""
    paired = np.bincount(own, s[:, 0] != s[:, 2], n) + np.abs(np.bincount(own, s[:, 4], n)) == 0
    order = np.lexsort((s[:, 0], s[:, 3], s[:, 1], own))
    even = order[paired[own[order]]]
    one, other = even[s[even, 4] > 0], even[s[even, 4] < 0]
    paired[own[one[(s[one][:, [1, 3]] != s[other][:, [1, 3]]).any(1)]]] = False
    both = np.stack([one, other], 1)[paired[own[one]]].ravel()
    order = np.concatenate([both, order[~paired[own[order]]]])
    order = order[np.argsort(own[order], kind="stable")]
    return s[order], own[order], paired


def shared_areas(a: np.ndarray, b: np.ndarray, x0: np.ndarray) -> np.ndarray:
    """The area that the polygons of each pair share: (pairs, sides, 5) of both, padded by sides of sign 0, and a place of each pair that abscissas count from.

    At each height the signs of a polygon's sides add up to nothing, so the area is minus the sum over pairs of sides of both signs times the integral of the larger abscissa."""
    (ax1, ay1, ax2, ay2, sa), (bx1, by1, bx2, by2, sb) = (np.moveaxis(v, -1, 0) for v in (a[:, :, None, :], b[:, None, :, :]))
    slope = lambda x1, y1, x2, y2: (x2 - x1) / np.where(y2 == y1, 1.0, y2 - y1)
    ma, mb = slope(ax1, ay1, ax2, ay2), slope(bx1, by1, bx2, by2)
    low, high = np.maximum(ay1, by1), np.minimum(ay2, by2)
    h = np.maximum(high - low, 0.0)
    base = x0[:, None, None]
    b0, b1 = bx1 - base + (low - by1) * mb, bx1 - base + (high - by1) * mb
    d0, d1 = ax1 - base + (low - ay1) * ma - b0, ax1 - base + (high - ay1) * ma - b1
    up, all_ = np.maximum(d0, 0.0) + np.maximum(d1, 0.0), np.abs(d0) + np.abs(d1)
    more = np.where(all_ > 0, up * up / np.where(all_ > 0, all_, 1.0), 0.0)
    return -(sa * sb * (h / 2) * (b0 + b1 + more)).sum((1, 2))


TILE = 1 << 15  # pairs of boxes looked at together
FEW_BOXES = 8  # pairs of boxes of two polygons that are all looked at


def signed_boxes(padded: np.ndarray) -> np.ndarray | None:
    """(polygons, boxes, 5) of (polygons, sides, 5) in pairs: minx, miny, maxx, maxy, sign; None if they are not."""
    one, other = padded[:, ::2], padded[:, 1::2]
    if one.shape != other.shape or (padded[:, :, 0] != padded[:, :, 2]).any() or (one[:, :, [1, 3]] != other[:, :, [1, 3]]).any() or (one[:, :, 4] != -other[:, :, 4]).any():
        return None
    a, b = one[:, :, 0], other[:, :, 0]
    return np.stack([np.minimum(a, b), one[:, :, 1], np.maximum(a, b), one[:, :, 3], one[:, :, 4] * np.sign(b - a)], 2)


def whole_numbers(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Signed boxes of two blocks as integers of few bytes, from a corner of their own; None if they are not whole numbers or an area may be too large."""
    every = [b[:, :, :4][b[:, :, 4] != 0] for b in (left, right)]
    if not all(len(b) and (b == np.rint(b)).all() for b in every):
        return None
    low = np.minimum(*(b[:, :2].min(0) for b in every))
    most = np.prod(np.maximum(*(b[:, 2:].max(0) for b in every)) - low) * left.shape[1] * right.shape[1]
    for kind in (np.int16, np.int32):
        if most <= np.iinfo(kind).max:
            shifted = [np.where(b[:, :, 4:] != 0, b - np.array([*low, *low, 0]), 0) for b in (left, right)]
            return shifted[0].astype(kind), shifted[1].astype(kind)
    return None


def box_areas(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places left, places right, areas that are not zero) of each polygon of two blocks with each of the other, by signed boxes."""
    step = max(1, TILE // len(right))
    columns = [[np.ascontiguousarray(right[:, v, c]) for c in range(5)] for v in range(right.shape[1])]
    whole = np.zeros((5, min(step, len(left)), len(right)), left.dtype)
    for first in range(0, len(left), step):
        part = left[first : first + step]
        area, w, h, low, zero = whole[:, : len(part)]
        area[:] = 0
        for ax1, ay1, ax2, ay2, sa in (part[:, u, :, None].transpose(1, 0, 2) for u in range(part.shape[1])):
            for bx1, by1, bx2, by2, sb in columns:
                np.subtract(np.minimum(ax2, bx2, out=w), np.maximum(ax1, bx1, out=low), out=w)
                np.subtract(np.minimum(ay2, by2, out=h), np.maximum(ay1, by1, out=low), out=h)
                np.multiply(np.maximum(w, zero, out=w), np.maximum(h, zero, out=h), out=w)
                if (sa == sa[0]).all() and (sb == sb[0]).all() and sa[0] * sb[0]:
                    (np.add if sa[0] * sb[0] > 0 else np.subtract)(area, w, out=area)
                else:
                    area += np.multiply(np.multiply(w, sa, out=w), sb, out=w)
        flat = np.flatnonzero(area)
        i = flat // len(right)
        yield i + first, flat - i * len(right), area.ravel()[flat]


LOOKED, FEWER = 1 << 16, 0.9
#: Kinds of boxes of a part, 1 if their x begins in it plus 2 if their y does, in an order in which those that go with a kind are in one piece.
KINDS, PIECES = (2, 3, 1, 0), {3: (0, 4), 1: (0, 2), 2: (1, 3), 0: (1, 2)}


def meetings(one: np.ndarray, other: np.ndarray, part: tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places left, places right), each of which is to be looked at with each: a pair of boxes of a part comes once if what they share begins in it, so if the x and the y of
    either box do. part: places and kinds of both. It is parted at a median for as long as that leaves fewer pairs."""

    def looked(part) -> int:
        a, b = (np.bincount(kinds, minlength=4) for _, kinds in part)
        return int(sum(a[k] * sum(b[m] for m in range(4) if k | m == 3) for k in range(4)))

    def halves(axis: int):
        bit = 1 + axis
        begun = np.concatenate([boxes[i[kinds & bit > 0], axis] for boxes, (i, kinds) in zip((one, other), part, strict=True)])
        at = np.partition(begun, len(begun) // 2)[len(begun) // 2]
        low, high = [], []
        for boxes, (i, kinds) in zip((one, other), part, strict=True):
            a, b = boxes[i, axis] < at, boxes[i, axis + 2] > at
            low.append((i[a], kinds[a]))
            high.append((i[b], (kinds[b] & ~bit) | np.where(a[b], 0, bit)))
        return low, high

    total = looked(part)
    if total > LOOKED:
        best = min((halves(axis) for axis in (0, 1)), key=lambda ps: sum(map(looked, ps)))
        if sum(map(looked, best)) < FEWER * total:
            for p in best:
                yield from meetings(one, other, p)
            return
    (i, kinds), (j, others) = part
    pieces = [j[others == k] for k in KINDS]
    for kind, (a, b) in PIECES.items():
        p, q = i[kinds == kind], np.concatenate(pieces[a:b])
        if len(p) and len(q):
            yield p, q


def block_areas(left: Sequence[np.ndarray], right: Sequence[np.ndarray], boxes: tuple[np.ndarray, np.ndarray], cell: tuple[int, int], side: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places left, places right, areas) of the pairs of two blocks that share an area and whose boxes' common part begins in the cell."""
    one, other = boxes
    padded = []
    for part in (left, right):
        n = np.array([len(s) for s in part])
        out = np.zeros((len(part), n.max(), 5))
        out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = np.concatenate(part)
        padded.append(out)
    pl, pr = padded
    signed = [signed_boxes(p) for p in padded] if pl.shape[1] * pr.shape[1] <= 4 * FEW_BOXES else [None, None]
    upright = all(s is not None for s in signed)
    exact = whole_numbers(*signed) if upright else None
    whole = tuple((np.arange(len(b)), (np.floor(b[:, 0] / side) == cell[0]) + 2 * (np.floor(b[:, 1] / side) == cell[1])) for b in boxes)
    for i, j in meetings(one, other, whole):
        if exact:
            yield from ((i[p], j[q], area.astype(float)) for p, q, area in box_areas(exact[0][i], exact[1][j]))
            continue
        if upright:
            found = ((i[p], j[q], area) for p, q, area in box_areas(signed[0][i], signed[1][j]))
        else:
            found = _side_areas(pl, pr, one, other, i, j)
        # No box of what two of them span is larger.
        most = 1e-12 * np.prod(np.maximum(one[i, 2:].max(0), other[j, 2:].max(0)) - np.minimum(one[i, :2].min(0), other[j, :2].min(0)))
        for p, q, area in found:
            # What is no more than rounding is settled by slabs.
            for n in np.flatnonzero((area != 0) & (np.abs(area) < most)):
                u, v = one[p[n]], other[q[n]]
                if abs(area[n]) < 1e-12 * np.prod(np.maximum(u[2:], v[2:]) - np.minimum(u[:2], v[:2])):
                    box = max(u[0], v[0]), max(u[1], v[1]), min(u[2], v[2]), min(u[3], v[3])
                    area[n] = cell_area([[left[p[n]][:, :4]], [right[q[n]][:, :4]]], box)
            kept = area > 0
            yield (p, q, area) if kept.all() else (p[kept], q[kept], area[kept])


def _side_areas(pl: np.ndarray, pr: np.ndarray, one: np.ndarray, other: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places left, places right, areas) of each of i with each of j whose boxes meet, by their sides."""
    size = pl.shape[1] * pr.shape[1]
    step, many = max(1, CALL // len(j)), max(1, CALL // size)
    for first in range(0, len(i), step):
        a, b = one[i[first : first + step], None, :], other[j]
        x0, y0 = np.maximum(a[..., 0], b[:, 0]), np.maximum(a[..., 1], b[:, 1])
        p, q = np.nonzero((x0 < np.minimum(a[..., 2], b[:, 2])) & (y0 < np.minimum(a[..., 3], b[:, 3])))
        at, p, q = x0[p, q], i[first + p], j[q]
        for k in range(0, len(p), many):
            u, v, x = p[k : k + many], q[k : k + many], at[k : k + many]
            if size <= CALL:
                area = shared_areas(pl[u], pr[v], x)
            else:  # polygons of many sides, some at a time
                rows = max(1, CALL // pr.shape[1])
                area = sum(shared_areas(pl[u][:, r : r + rows], pr[v], x) for r in range(0, pl.shape[1], rows))
            yield u, v, area


BLOCK = 1 << 15  # sides of a block
PAIRS = 1 << 16  # pairs given at once


def edges_in(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges, whose they are, each polygon's row) of a column of arrays of polygons; rings of fewer than three corners are none."""
    counts = lambda c: pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(int)
    rows = np.repeat(np.arange(len(column)), counts(column))
    polygons = column.flatten()
    own = np.repeat(np.arange(len(polygons)), counts(polygons))
    rings = polygons.flatten()
    n = counts(rings)
    corners = rings.flatten()
    first = np.cumsum(width := counts(corners)) - width
    flat = corners.flatten().to_numpy(zero_copy_only=False).astype(float)
    p = flat[first[:, None] + np.arange(2)] if len(first) else np.zeros((0, 2))
    end = np.cumsum(n)
    following = np.arange(1, len(p) + 1)
    following[end[n > 0] - 1] = (end - n)[n > 0]
    long = np.repeat(n > 2, n)
    return np.concatenate([p, p[following]], 1)[long], np.repeat(own, n)[long], rows


def _blocks(polygons: DataFrame, name: str, side: float, rings: str) -> DataFrame:
    """(cx, cy, number and box of the block, ids, sides): polygons as signed sides, by the cells that their boxes touch, in blocks of bounded size; those of one id count as one."""
    kind = dict(polygons.dtypes)["id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e, own, rows = edges_in(b.column("many"))
            s, own = many_sides(e, own)
            s, own, paired = in_pairs(s, rows[own], b.num_rows)
            if not len(s):
                continue
            at, start, n = np.unique(own, return_index=True, return_counts=True)
            x, y = s[:, [0, 2]], s[:, [1, 3]]
            box = [np.minimum.reduceat(x.min(1), start), np.minimum.reduceat(y.min(1), start), np.maximum.reduceat(x.max(1), start), np.maximum.reduceat(y.max(1), start)]
            data = s.tobytes()
            packed = [data[40 * f : 40 * (f + k)] for f, k in zip(start.tolist(), n.tolist(), strict=True)]
            columns = [b.column("id").take(pa.array(at)), *map(pa.array, box), pa.array(n.astype("int32")), pa.array(paired[at]), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "minx", "miny", "maxx", "maxy", "n", "paired", "sides"])

    whole = polygons.select("id", F.col(rings).alias("rings")).groupBy("id").agg(F.collect_list("rings").alias("many"))
    known = whole.mapInArrow(read, f"id {kind}, minx double, miny double, maxx double, maxy double, n int, paired boolean, sides binary")
    steps = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / side).cast("long"), F.floor(F.col(b) / side).cast("long")))
    filed = known.select("*", steps("minx", "maxx").alias("cx")).select("*", steps("miny", "maxy").alias("cy"))
    # Of near numbers of sides, so that they are padded to about the same, from west to east.
    filed = filed.withColumn("like", F.ceil(F.log2("n")) * 2 + F.col("paired").cast("int"))
    order = Window.partitionBy("cx", "cy").orderBy("like", "minx", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filed = filed.withColumn("block", F.floor(F.sum("n").over(order) / BLOCK))
    box = [F.min(c).alias(f"{name}_{c}") for c in ("minx", "miny")] + [F.max(c).alias(f"{name}_{c}") for c in ("maxx", "maxy")]
    blocks = filed.groupBy("cx", "cy", "like", "block").agg(*box, F.collect_list(F.struct("id", "sides")).alias("rows"))
    return blocks.select("cx", "cy", F.struct("like", "block").alias(f"{name}_block"), *(f"{name}_{c}" for c in ("minx", "miny", "maxx", "maxy")), F.col("rows.id").alias(name), F.col("rows.sides").alias(f"{name}_sides"))


def overlaps(left: DataFrame, right: DataFrame, side: float, rings: str = "rings") -> DataFrame:
    """(left, right, area) of the polygons (id, rings) of two tables whose insides meet. Blocks of polygons meet by cells and are dealt to all tasks; each pair is one row of one task."""
    kinds = {"left": dict(left.dtypes)["id"], "right": dict(right.dtypes)["id"]}
    names = ("left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                ids, polygons, boxes = [], [], []
                for name in names:
                    packed = b.column(f"{name}_sides")[row].values.to_pylist()
                    s = np.frombuffer(b"".join(packed)).reshape(-1, 5)
                    start = np.cumsum([0, *(len(x) // 40 for x in packed)])
                    polygons.append([s[f:t] for f, t in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)])
                    lows, highs = np.minimum.reduceat(s, start[:-1]), np.maximum.reduceat(s, start[:-1])
                    boxes.append(np.stack([lows[:, [0, 2]].min(1), lows[:, 1], highs[:, [0, 2]].max(1), highs[:, 3]], 1))
                    ids.append(b.column(name)[row].values)
                cell = b.column("cx")[row].as_py(), b.column("cy")[row].as_py()
                some, n = [], 0
                for found in block_areas(*polygons, tuple(boxes), cell, side):
                    some.append(found)
                    n += len(found[0])
                    if n >= PAIRS:
                        yield gathered(ids, some)
                        some, n = [], 0
                if n:
                    yield gathered(ids, some)

    def gathered(ids: list[pa.Array], some: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        p, q, area = map(np.concatenate, zip(*some, strict=True))
        return pa.RecordBatch.from_arrays([ids[0].take(pa.array(p)), ids[1].take(pa.array(q)), pa.array(area)], ["left", "right", "area"])

    one, other = _blocks(left, "left", side, rings), _blocks(right, "right", side, rings)
    near = (F.col("left_minx") < F.col("right_maxx")) & (F.col("right_minx") < F.col("left_maxx")) & (F.col("left_miny") < F.col("right_maxy")) & (F.col("right_miny") < F.col("left_maxy"))
    tasks = 8 * left.sparkSession.sparkContext.defaultParallelism
    met = one.join(other, ["cx", "cy"]).where(near).repartition(tasks, "cx", "cy", "left_block", "right_block")
    return met.select("cx", "cy", *names, *(f"{n}_sides" for n in names)).mapInArrow(run, f"left {kinds['left']}, right {kinds['right']}, area double")
