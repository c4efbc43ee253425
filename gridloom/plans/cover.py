"""Exact cover of cells by polygons: areas are kept as convex pieces, and a polygon is taken from them by its triangles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import per_group

Ring = Sequence[tuple[float, float]]
LEAST = 1e-8  # square degrees that count


def area(ring: Ring) -> float:
    """Signed: positive if it runs counterclockwise."""
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, [*ring[1:], *ring[:1]], strict=True)) / 2


def _side(a, b, p) -> float:
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def triangles(ring: Ring) -> list[list[tuple[float, float]]]:
    """A simple polygon as counterclockwise triangles, by cutting ears."""
    left = [tuple(map(float, p)) for p in ring]
    left = [p for i, p in enumerate(left) if p != left[i - 1]]
    if area(left) < 0:
        left.reverse()
    out = []
    while len(left) > 3:
        for i in range(len(left)):
            a, b, c = left[i - 1], left[i], left[(i + 1) % len(left)]
            if _side(a, b, c) > 0 and not any(_side(a, b, p) >= 0 and _side(b, c, p) >= 0 and _side(c, a, p) >= 0 for p in left if p not in (a, b, c)):
                out.append([a, b, c])
                del left[i]
                break
        else:  # what is left has no area, or crosses itself
            flat = [i for i in range(len(left)) if _side(left[i - 1], left[i], left[(i + 1) % len(left)]) == 0]
            if not flat:
                raise ValueError("not a simple polygon")
            del left[flat[0]]
    return [*out, left] if len(left) == 3 and area(left) > 0 else out


def _cut(piece: Ring, a, b) -> tuple[list, list]:
    """The parts of a convex piece to the left and to the right of a line from a to b."""
    left, right = [], []
    for p, q in zip(piece, [*piece[1:], piece[0]], strict=True):
        u, v = _side(a, b, p), _side(a, b, q)
        if u >= 0:
            left.append(p)
        if u <= 0:
            right.append(p)
        if u * v < 0:
            t = u / (u - v)
            cross = (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
            left.append(cross)
            right.append(cross)
    return left, right


def parts(ring: Ring) -> list[list[tuple[float, float]]]:
    """A simple polygon as convex pieces: itself, or its triangles."""
    points = [tuple(map(float, p)) for p in ring]
    points = points[::-1] if area(points) < 0 else points
    if len(points) > 2 and area(points) > 0 and all(_side(points[i - 2], points[i - 1], points[i]) > 0 for i in range(len(points))):
        return [points]
    return triangles(ring)


def apart(a: Ring, b: Ring) -> bool:
    """Whether a side of one of two convex polygons has all of the other beyond it."""
    for one, other in ((a, b), (b, a)):
        for p, q in zip(one, [*one[1:], one[0]], strict=True):
            dx, dy = q[0] - p[0], q[1] - p[1]
            if abs(dx) + abs(dy) > 1e-12 and all(dx * (y - p[1]) - dy * (x - p[0]) <= 0 for x, y in other):
                return True
    return False


def without(pieces: list, convex: Ring) -> tuple[list, float]:
    """What is left of convex pieces without a convex polygon, and the area that went."""
    out, gone = [], 0.0
    xs, ys = zip(*convex, strict=True)
    west, east, south, north = min(xs), max(xs), min(ys), max(ys)
    for piece in pieces:
        px, py = zip(*piece, strict=True)
        if max(px) <= west or min(px) >= east or max(py) <= south or min(py) >= north or apart(piece, convex):
            out.append(piece)
            continue
        inside = piece
        for a, b in zip(convex, [*convex[1:], convex[0]], strict=True):
            inside, beyond = _cut(inside, a, b)
            if len(beyond) > 2 and area(beyond) > 1e-15:
                out.append(beyond)
            if len(inside) < 3:
                break
        gone += max(0.0, area(inside))
    return out, gone


def chosen(target: Ring, rings: Sequence[Ring | None], least: float = LEAST) -> list[int]:
    """The places of the rings, taken in order, that cover more than ``least`` of what of the target none before did; until less is left."""
    left, out, known = parts(target), [], set()
    for i, ring in enumerate(rings):
        if ring is None or len(ring) < 3 or (same := tuple(map(tuple, ring))) in known:
            continue
        known.add(same)  # what was taken once, or was too little, is so again
        rest, gone = left, 0.0
        for t in parts(ring):
            rest, part = without(rest, t)
            gone += part
        if gone > least:
            out.append(i)
            left = rest
            if sum(map(area, left)) < least:
                break
    return out


def greedy_cover(scenes: DataFrame, cell: str, start: str, ring: str, target: Ring, seq: str = "seq") -> DataFrame:
    """(cell, seq): the scenes of each cell, newest first, whose polygons (arrays of x, y) cover something of the target that none before did.

    A cell is one of a quadtree's, so its scenes are of bounded number; scenes without a polygon never count."""
    kinds = dict(scenes.dtypes)
    target = [tuple(p) for p in target]

    def run(t: dict[str, np.ndarray]) -> tuple:
        order = sorted(range(len(t["seq"])), key=lambda i: t["seq"][i])
        order.sort(key=lambda i: t["start"][i], reverse=True)
        keep = chosen(target, [None if t["ring"][i] is None else [tuple(p) for p in t["ring"][i]] for i in order])
        return t["cell"][0], [t["seq"][order[k]] for k in keep]

    rows = scenes.select(F.col(cell).alias("cell"), F.col(seq).alias("seq"), F.coalesce(start, F.lit("")).alias("start"), F.col(ring).alias("ring"))
    found = per_group(rows, ["cell"], run, f"cell {kinds[cell]}, seqs array<{kinds[seq]}>")
    return found.select(F.col("cell").alias(cell), F.explode("seqs").alias(seq))


def union_area(shapes: DataFrame, key: str, ring: str, target: Ring) -> DataFrame:
    """(key, area): how much of the target a bounded group's polygons cover together."""
    target = [tuple(p) for p in target]

    def run(group: dict[str, np.ndarray]) -> tuple:
        left = parts(target)
        for r in dict.fromkeys(tuple(map(tuple, r)) for r in group["ring"] if r is not None and len(r) > 2):
            for t in parts(r):
                left, _ = without(left, t)
        return group["key"][0], abs(area(target)) - sum(map(area, left))

    return per_group(shapes.select(F.col(key).alias("key"), F.col(ring).alias("ring")), ["key"], run, f"`{key}` {dict(shapes.dtypes)[key]}, area double")
