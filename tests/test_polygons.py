"""Polygons: clipping against sampling, dissolved outlines, simplification and well-known text."""

import numpy as np
import pytest

from cadastra.operators.polygons import clip_convex, dissolve, fitted, signed_area, simplify, wkt_rings


def hull(points):
    centre = points.mean(0)
    return points[np.argsort(np.arctan2(*(points - centre).T[::-1]))]


def inside(ring, p):
    q = np.roll(ring, -1, axis=0)
    return ((q - ring)[:, 0] * (p[:, None, 1] - ring[:, 1]) - (q - ring)[:, 1] * (p[:, None, 0] - ring[:, 0]) >= 0).all(1)


@pytest.mark.parametrize("seed", range(5))
def test_clip_against_sampling(seed):
    r = np.random.default_rng(seed)
    turn = lambda n: np.sort(r.uniform(0, 2 * np.pi, n))
    a, b = (np.column_stack([np.cos(t), np.sin(t)]) * 3 + r.uniform(-1, 1, 2) for t in (turn(7), turn(6)))
    at = r.uniform(-5, 5, (200_000, 2))
    share = (inside(a, at) & inside(b, at)).mean() * 100
    assert abs(abs(signed_area(clip_convex(a, b))) - share) < 0.35
    assert abs(abs(signed_area(clip_convex(a, b[::-1]))) - abs(signed_area(clip_convex(b, a)))) < 1e-9


def square(x, y, w=1.0, h=1.0):
    return np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)])


def test_dissolve():
    whole = dissolve([square(0, 0), square(1, 0), square(0, 1, 2, 1)])
    assert len(whole) == 1 and signed_area(whole[0]) == 4
    ring = [square(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    parts = sorted(signed_area(r) for r in dissolve(ring))
    assert parts == [-1, 9]
    assert sorted(signed_area(r) for r in dissolve([square(0, 0), square(1, 1)])) in ([1, 1], [2]) and dissolve([]) == []
    assert sum(signed_area(r) for r in dissolve([square(0, 0)[::-1], square(1, 0.25, 1, 0.5)])) == 1.5


def test_simplify():
    turn = np.linspace(0, 2 * np.pi, 400, endpoint=False)
    circle = np.column_stack([np.cos(turn), np.sin(turn)]) * 1000
    small = simplify(circle, 15.0)
    assert 8 < len(small) < 60 and abs(signed_area(small) / signed_area(circle) - 1) < 0.03
    assert len(simplify(circle, 1e9)) >= 3 and len(simplify(circle[:3], 5.0)) == 3
    assert fitted([circle], 100_000)[1] == 5.0 and fitted([circle], 600)[1] > 5.0 and fitted([circle], 1)[1] == 250.0


def test_wkt():
    assert [r.tolist() for r in wkt_rings("POLYGON ((0 0, 2 0, 2 2, 0 0), (1 .5, 1.5 .5, 1.5 1e0, 1 .5))")] == [[[0, 0], [2, 0], [2, 2]], [[1, 0.5], [1.5, 0.5], [1.5, 1]]]
    assert len(wkt_rings("multipolygon(((0 0,1 0,1 1)),((5 5,6 5,6 6,5 5)))")) == 2
    assert [wkt_rings(x) for x in (None, "", "POINT (1 2)", "POLYGON ((0 0, 1 1))", "POLYGON ((0 0, 1 1, 2 2")] == [None] * 5
