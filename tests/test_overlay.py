"""Unions and overlaps of polygons against points, and against themselves in other grids."""

import math
import random

import numpy as np
import pytest

from gridloom.plans import overlay
from gridloom.sources import files


def star(rnd, x, y, r, n):
    return [[x + r * rnd.uniform(0.4, 1) * math.cos(2 * math.pi * i / n), y + r * rnd.uniform(0.4, 1) * math.sin(2 * math.pi * i / n)] for i in range(n)]


def shapes(n=14):
    rnd = random.Random(3)
    out = []
    for i in range(n):
        x, y, r = rnd.uniform(-20, 20), rnd.uniform(-20, 20), rnd.uniform(2, 9)
        rings = [star(rnd, x, y, r, rnd.randint(3, 9))]
        if i % 3 == 0:
            rings.append([[x - 0.2 * r, y - 0.2 * r], [x + 0.2 * r, y - 0.2 * r], [x, y + 0.25 * r]])
        out.append((i, i % 2, rings))
    return [*out, out[0], (90, 0, [[[-8.0, -8.0], [0.0, -8.0], [0.0, 0.0], [-8.0, 0.0]]]), (91, 0, [[[0.0, -8.0], [8.0, -8.0], [8.0, 0.0], [0.0, 0.0]]])]


ROWS = "id int, key int, rings array<array<array<double>>>"


def sums(cells):
    out = {}
    for r in cells.collect():
        a, n, lines = out.setdefault(r.key, [0.0, 0.0, []])
        out[r.key] = [a + r.area, n + sum(math.hypot(s.x2 - s.x1, s.y2 - s.y1) for s in r.outline), lines + [tuple(s) for s in r.outline]]
    return out


def test_union_does_not_depend_on_the_grid(spark):
    df = spark.createDataFrame(shapes(), ROWS)
    one, many, odd = (sums(overlay.union(df, ["key"], side)) for side in (1000.0, 4.0, 2.7))
    for key in one:
        for other in (many, odd):
            assert other[key][0] == pytest.approx(one[key][0], rel=1e-9) and other[key][1] == pytest.approx(one[key][1], rel=1e-7)
    # Points dropped at random: the share that any polygon holds is the area.
    rnd = np.random.default_rng(0)
    points = rnd.uniform(-30, 30, (200_000, 2))
    for key in one:
        inside = overlay.covered(points, [overlay.edges_of([np.array(r) for r in rings]) for _, k, rings in shapes() if k == key])
        assert one[key][0] == pytest.approx(inside.mean() * 3600, abs=3600 * 3 * math.sqrt(0.25 / 200_000))
    # Along the outline exactly one side is covered, and each corner has an even number of ends.
    for key, (_, _, lines) in one.items():
        ends = {}
        for x1, y1, x2, y2 in lines:
            for p in ((round(x1, 6), round(y1, 6)), (round(x2, 6), round(y2, 6))):
                ends[p] = ends.get(p, 0) + 1
        assert all(n % 2 == 0 for n in ends.values()) and key in (0, 1)


def test_overlaps_equal_plain_ones(spark):
    left, right = [s for s in shapes() if s[0] % 2 == 0 and s[0] < 90][:7], [s for s in shapes() if s[0] % 2][:7]
    pick = lambda rows: spark.createDataFrame([(i, r) for i, _, r in dict((s[0], s) for s in rows).values()], "id int, rings array<array<array<double>>>")
    got = {(r.left, r.right): r.area for r in overlay.overlaps(pick(left), pick(right), 3.3).collect()}
    want = {}
    for i, _, a in left:
        for j, _, b in right:
            area = overlay.cell_area([[overlay.edges_of([np.array(r) for r in a])], [overlay.edges_of([np.array(r) for r in b])]], (-99, -99, 99, 99))
            if area > 1e-12:
                want[i, j] = area
    assert got.keys() == want.keys() and want and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_simple_cases(spark):
    square = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]
    hole = [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0]]
    rows = [(1, 1, [square, hole]), (2, 1, [[[4.0, 0.0], [6.0, 0.0], [6.0, 4.0], [4.0, 4.0]]]), (3, 2, [square, hole]), (4, 2, [hole]), (5, 3, []), (6, 3, None), (7, 3, [[[0.0, 0.0], [1.0, 1.0]]]), (8, 4, [None, square]), (9, 4, [square]), (10, 5, [[*square, square[0]]])]
    for side in (100.0, 4.0, 1.0):
        got = sums(overlay.union(spark.createDataFrame(rows, ROWS), ["key"], side))
        # Side by side without a border between them; a filled hole; copies; a ring that is closed already.
        assert {k: (round(a, 9), round(n, 9)) for k, (a, n, _) in got.items() if a} == {1: (23.0, 24.0), 2: (16.0, 16.0), 4: (16.0, 16.0), 5: (16.0, 16.0)}
    none = spark.createDataFrame([], ROWS)
    assert overlay.union(none, ["key"], 1.0).count() == 0 and overlay.overlaps(none, none, 1.0).count() == 0
    # Touching is no overlap.
    one, other = (spark.createDataFrame([(i, [r])], "id int, rings array<array<array<double>>>") for i, r in ((1, square), (2, rows[1][2][0])))
    assert overlay.overlaps(one, other, 3.0).count() == 0


def test_outlines_keep_their_holes(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"features": [{"geometry": {"type": "Polygon", "coordinates": [[[0,0],[4,0],[4,4],[0,0]],[[2,1],[3,1],[3,2],[2,1]]]}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[[[9,9],[10,9],[9,10],[9,9]]],[[[20,0],[21,0],[20,1],[20,0]],[[20.1,0.1],[20.2,0.1],[20.1,0.2],[20.1,0.1]]]]}}]}')
    got = sorted((r.feature, r.part, [len(x) for x in r.rings]) for r in files.polygons(spark, str(tmp_path / "a.geojson")).collect())
    assert got == [(0, 0, [4, 4]), (1, 0, [4]), (1, 1, [4, 4])]


def test_shared_cells_are_quartered_until_few_polygons_meet():
    rnd = random.Random(5)
    squares = [(rnd.randrange(40), rnd.randrange(40), rnd.randint(2, 9), rnd.randint(2, 9)) for _ in range(1200)]
    ring = lambda x, y, w, h: np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)], float)
    polygons = [overlay.edges_of([ring(*s), ring(s[0] + 1, s[1] + 1, 0.5, 0.5)]) for s in squares]
    box = (0.0, 0.0, 50.0, 50.0)
    found = list(overlay.parted(np.concatenate(polygons), np.repeat(np.arange(len(polygons)), [len(e) for e in polygons]), box))
    # What the pairwise steps see is few polygons, and most parts are settled without them.
    assert max(len(p) for _, p in found if p is not None) < 40 and sum(p is None for _, p in found) > 10
    half = lambda x, y, w, h: {(2 * x + i, 2 * y + j) for i in range(2 * w) for j in range(2 * h)} - {(2 * x + 2, 2 * y + 2)}
    held = set().union(*(half(*s) for s in squares))
    held = {c for c in held if c[0] < 100 and c[1] < 100}
    area, lines = overlay.cell_union(polygons, box)
    edge = sum((x + i, y + j) not in held for x, y in held for i, j in ((0, 1), (1, 0), (0, -1), (-1, 0))) / 2
    assert area == pytest.approx(len(held) / 4, rel=1e-12) and np.hypot(lines[:, 2] - lines[:, 0], lines[:, 3] - lines[:, 1]).sum() == pytest.approx(edge, rel=1e-9)


def test_many_overlaps_are_taken_together(monkeypatch):
    rnd = random.Random(6)
    rows = [(rnd.randrange(8), rnd.randrange(8), rnd.randint(3, 9), rnd.randint(3, 9)) for _ in range(600)]
    ring = lambda x, y, w, h: np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)], float)
    polygons = [overlay.sides([ring(*s), ring(s[0] + 1, s[1] + 1, 1, 1)]) for s in rows]
    assert all(len(s) == 4 for s in polygons)
    held = [{(x + i, y + j) for i in range(w) for j in range(h)} - {(x + 1, y + 1)} for x, y, w, h in rows]
    boxes = np.array([(x, y, x + w, y + h) for x, y, w, h in rows], float)
    # None of these pairs needs slabs of its own.
    monkeypatch.setattr(overlay, "cell_area", None)
    got = {}
    for p, q, area in overlay.block_areas(polygons[:300], polygons[300:], (boxes[:300], boxes[300:]), (0, 0), 50.0):
        got |= dict(zip(zip(p.tolist(), q.tolist(), strict=True), area.tolist(), strict=True))
    want = {(i, j): float(len(held[i] & held[300 + j])) for i in range(300) for j in range(300)}
    assert got == {k: v for k, v in want.items() if v}


def test_many_sides_are_those_of_one_polygon_each():
    rnd = random.Random(8)
    ring = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    polygons = [[ring(0, 0, 4, 4), ring(1, 1, 1, 1)], [ring(0, 0, 4, 4), ring(1, 0, 1, 4)], [[(0, 0), (4, 0), (4, 1), (2, 1), (2, 3), (0, 3)]], [[(0, 0), (4, 4), (4, 0), (0, 3)]], [[(1, 1), (2, 1)]], [], [[(0, 0), (5, 0), (5, 0)]]]
    polygons += [[star(rnd, rnd.uniform(-9, 9), rnd.uniform(-9, 9), 5, rnd.randint(3, 80))] for _ in range(60)]
    polygons = [[np.array(r, float) for r in rings] for rings in polygons]
    e = [overlay.edges_of(rings) for rings in polygons]
    s, own = overlay.many_sides(np.concatenate(e), np.repeat(np.arange(len(e)), [len(x) for x in e]))
    for k, rings in enumerate(polygons):
        want = overlay.sides(rings)
        got = s[own == k]
        assert len(got) == len(want) and np.allclose(got[np.lexsort(got.T)], want[np.lexsort(want.T)], rtol=0, atol=1e-12)
    # Pairs of upright sides follow each other; a polygon that has no such pairs, or is not upright, keeps its sides.
    t, whose, paired = overlay.in_pairs(s, own, len(polygons))
    assert paired[:4].tolist() == [True, True, False, False] and not paired[7:].any() and (np.diff(whose) >= 0).all()
    for k in range(len(polygons)):
        assert sorted(map(tuple, t[whose == k])) == sorted(map(tuple, s[own == k]))
        boxes = overlay.signed_boxes(t[whose == k][None])
        assert not paired[k] or boxes is not None and (boxes[0, :, 4] * (boxes[0, :, 2] - boxes[0, :, 0]) * (boxes[0, :, 3] - boxes[0, :, 1])).sum() == pytest.approx([15, 12][k] if k < 2 else 0)


def test_upright_polygons_are_boxes(monkeypatch):
    rnd = random.Random(9)
    rows = [(rnd.randrange(20), rnd.randrange(20), rnd.randint(1, 6), rnd.randint(1, 6)) for _ in range(900)]
    ring = lambda x, y, w, h: np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)], float)
    rings = [[ring(*s), ring(s[0] + 1, s[1] + 1, 1, 1)] if min(s[2:]) > 2 else [ring(*s)] for s in rows]
    e = [overlay.edges_of(r) for r in rings]
    s, own = overlay.many_sides(np.concatenate(e), np.repeat(np.arange(900), [len(x) for x in e]))
    s, own, paired = overlay.in_pairs(s, own, 900)
    assert paired.all()
    held = [{(x + i, y + j) for i in range(w) for j in range(h)} - ({(x + 1, y + 1)} if min(w, h) > 2 else set()) for x, y, w, h in rows]
    polygons, boxes = [s[own == k] for k in range(900)], np.array([(x, y, x + w, y + h) for x, y, w, h in rows], float)
    want = {(i, j): float(len(held[i] & held[300 + j])) for i in range(300) for j in range(600)}
    want = {k: v for k, v in want.items() if v}
    # Neither sums over pairs of sides nor slabs are needed, and each pair is found in one of the cells.
    monkeypatch.setattr(overlay, "shared_areas", None)
    monkeypatch.setattr(overlay, "cell_area", None)
    monkeypatch.setattr(overlay, "LOOKED", 500)
    for side in (100.0, 7.5):
        got = {}
        for cx in range(int(26 // side) + 1):
            for cy in range(int(26 // side) + 1):
                here = [np.flatnonzero((b[:, 0] < (cx + 1) * side) & (b[:, 2] >= cx * side) & (b[:, 1] < (cy + 1) * side) & (b[:, 3] >= cy * side)) for b in (boxes[:300], boxes[300:])]
                if not all(map(len, here)):
                    continue
                for p, q, area in overlay.block_areas([polygons[i] for i in here[0]], [polygons[300 + j] for j in here[1]], (boxes[here[0]], boxes[300 + here[1]]), (cx, cy), side):
                    found = list(zip(here[0][p].tolist(), here[1][q].tolist(), strict=True))
                    assert not got.keys() & set(found) and len(set(found)) == len(found)
                    got |= dict(zip(found, area.tolist(), strict=True))
        assert got == want
    # Of all pairs few are looked at that do not meet.
    whole = tuple((np.arange(len(b)), np.full(len(b), 3)) for b in (boxes[:300], boxes[300:]))
    looked = [(i, j) for p, q in overlay.meetings(boxes[:300], boxes[300:], whole) for i in p.tolist() for j in q.tolist()]
    assert len(set(looked)) == len(looked) and set(want) <= set(looked) and len(looked) < 0.4 * 300 * 600


def test_overlaps_of_rows_of_one_id(spark):
    ring = lambda x, y, w, h: [[x, y], [x + w, y], [x + w, y + h], [x, y + h]]
    left = [("a", [ring(0.0, 0.0, 4.0, 4.0), ring(1.0, 1.0, 1.0, 1.0)]), ("b", None), ("c", [None, [[0.0, 0.0], [1.0, 1.0]]]), ("d", [[[0.0, 0.0], [4.0, 0.0], [0.0, 4.0]]])]
    right = [(1, [ring(3.0, 3.0, 9.0, 2.0)]), (1, [ring(0.0, 0.0, 2.0, 2.0)]), (2, [ring(1.0, 1.0, 1.0, 1.0)]), (3, [ring(-30.0, -30.0, 60.0, 60.0)])]
    one, other = (spark.createDataFrame(rows, f"id {kind}, rings array<array<array<double>>>") for rows, kind in ((left, "string"), (right, "int")))
    got = {(r.left, r.right): r.area for r in overlay.overlaps(one, other, 2.5).collect()}
    assert got == pytest.approx({("a", 1): 4.0, ("a", 3): 15.0, ("d", 1): 4.0, ("d", 2): 1.0, ("d", 3): 8.0})


def test_whole_numbers_take_few_bytes():
    rnd = random.Random(10)
    x, y, w, h = (np.array([rnd.randint(a, b) for _ in range(400)], float) for a, b in ((-5, 30), (-5, 30), (3, 9), (3, 9)))
    one, minus = np.ones(400), -np.ones(400)
    boxes = np.stack([np.stack([x, y, x + w, y + h, one], 1), np.stack([x + 1, y + 1, x + 2, y + 2, minus], 1)], 1)
    boxes[::3, 1] = 0  # no hole: padding
    want = np.zeros((150, 250))
    for p, q, area in overlay.box_areas(boxes[:150], boxes[150:]):
        want[p, q] = area
    assert (want >= 0).all() and (want > 0).any()
    for scale, kind in ((1, np.int16), (20, np.int32), (3000, None), (0.5, None)):
        b = boxes * [scale, scale, scale, scale, 1]
        small = overlay.whole_numbers(b[:150], b[150:])
        assert small is None if kind is None else small[0].dtype == small[1].dtype == kind
        got = np.zeros((150, 250))
        for p, q, area in overlay.box_areas(*(small or (b[:150], b[150:]))):
            got[p, q] = area
        assert np.array_equal(got, want * scale * scale)
