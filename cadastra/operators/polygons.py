"""Polygons of stations: well-known text, dissolved cells, overlap measures, adaptive simplification, buffers of points.

A ring is array<struct<x,y>> without a repeated last vertex; a polygon's holes turn the other way than its shell.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.operators.spatial import clip_half_plane

RING = "array<struct<x:double,y:double>>"
RINGS = f"array<{RING}>"
#: Vertices are compared on a grid of this many steps a metre.
GRID = 1000
#: Vertices that are clipped at once.
CLIPPED_AT_ONCE = 100_000
# Tolerances that are tried in turn, in metres, and the size that a shape must fit, in bytes.
TOLERANCES, MOST_BYTES = (5.0, 15.0, 40.0, 100.0, 250.0), 45_000
_NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"
_WKT_RING = re.compile(r"\(([^()]+)\)")
_PAIR = re.compile(rf"({_NUMBER})\s+({_NUMBER})")


def signed_area(ring: np.ndarray) -> float:
    x, y = ring.T if len(ring) else (np.zeros(0), np.zeros(0))
    return float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2


def _out(rings: list[np.ndarray]) -> list[list[dict]]:
    return [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


def _in(ring) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2)


def wkt_rings(text: str | None) -> list[np.ndarray] | None:
    """Rings of a POLYGON or MULTIPOLYGON text, the closing vertex left out; None for any other or broken text."""
    if not text or not re.match(r"\s*(MULTI)?POLYGON\s*\(", text, re.I) or text.count("(") != text.count(")"):
        return None
    rings = []
    for body in _WKT_RING.findall(text):
        ring = np.array([(float(a), float(b)) for a, b in _PAIR.findall(body)]).reshape(-1, 2)
        ring = ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring
        if len(ring) < 3:
            return None
        rings.append(ring)
    return rings or None


def read_wkt(df: DataFrame, id_col: str, wkt_col: str, only: DataFrame | None = None) -> DataFrame:
    """(id, rings) of the rows whose text is a polygon; bad rows are left out, and so are ids that ``only`` does not have."""

    @F.pandas_udf(RINGS)
    def parse(texts: pd.Series) -> pd.Series:
        return pd.Series([None if (r := wkt_rings(t)) is None else _out(r) for t in texts], dtype=object)

    some = df if only is None else df.join(only.select(id_col).distinct(), id_col, "left_semi")
    return some.select(id_col, parse(wkt_col).alias("rings")).where("rings IS NOT NULL")


def dissolve(rings: list[np.ndarray]) -> list[np.ndarray]:
    """The outline of polygons that touch but do not overlap: edges that two of them share in opposite directions go.

    Edges are cut where a vertex of another ring lies on them, so neighbours need not share their vertices.
    """
    snapped = [np.round(r * GRID).astype(np.int64) for r in rings]
    snapped = [r if signed_area(r.astype(float)) >= 0 else r[::-1] for r in snapped]
    corners = np.unique(np.concatenate(snapped), axis=0) if snapped else np.zeros((0, 2), np.int64)
    corners = corners[np.lexsort((corners[:, 1], corners[:, 0]))]
    open_edges: dict[tuple, int] = {}
    for r in snapped:
        for p, q in zip(r, np.roll(r, -1, axis=0), strict=True):
            lo, hi = np.searchsorted(corners[:, 0], [min(p[0], q[0]) - 1, max(p[0], q[0]) + 2])
            near, way = corners[lo:hi], (q - p).astype(float)
            length = math.hypot(*way)
            if not length:
                continue
            along, aside = (near - p) @ way / length, np.abs((near - p) @ np.array([-way[1], way[0]])) / length
            on = (aside <= 1.0) & (along > 1.0) & (along < length - 1.0)
            stops = [tuple(p), *map(tuple, near[on][np.argsort(along[on])]), tuple(q)]
            for a, b in zip(stops, stops[1:], strict=False):
                a, b = (int(a[0]), int(a[1])), (int(b[0]), int(b[1]))
                if open_edges.get((b, a), 0):
                    open_edges[b, a] -= 1
                else:
                    open_edges[a, b] = open_edges.get((a, b), 0) + 1
    after: dict[tuple, list[tuple]] = {}
    for (a, b), n in open_edges.items():
        if n:
            after.setdefault(a, []).extend([b] * n)
    out = []
    while after:
        start = min(after)
        ring, at, came = [start], start, None
        while True:
            ways = after[at]
            if came is not None and len(ways) > 1:
                back = math.atan2(came[1] - at[1], came[0] - at[0])
                ways.sort(key=lambda w: (back - math.atan2(w[1] - at[1], w[0] - at[0])) % (2 * math.pi))
            then = ways.pop(0)
            if not ways:
                del after[at]
            if then == start:
                break
            came, at = at, then
            ring.append(at)
        out.append(np.array(ring, float) / GRID)
    return out


def dissolved(cells: DataFrame, key: str) -> DataFrame:
    """cells(key, ring) of touching cells -> (key, rings, area, perimeter), one row a key; a key's cells meet in one task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rings = dissolve([_in(r) for r in pdf["ring"]])
        around = sum(float(np.hypot(*(np.roll(r, -1, axis=0) - r).T).sum()) for r in rings)
        return pd.DataFrame([{key: pdf[key].iloc[0], "rings": _out(rings), "area": sum(map(signed_area, rings)), "perimeter": around}])

    kind = cells.schema[key].dataType.simpleString()
    return cells.select(key, "ring").groupBy(key).applyInPandas(run, f"{key} {kind}, rings {RINGS}, area double, perimeter double")


def clip_convex(ring: np.ndarray, window: np.ndarray) -> np.ndarray:
    """The part of a ring within a convex window."""
    window = window if signed_area(window) >= 0 else window[::-1]
    for p, q in zip(window, np.roll(window, -1, axis=0), strict=True):
        way = q - p
        ring = clip_half_plane(ring, p, np.array([way[1], -way[0]]))
        if not len(ring):
            break
    return ring


def centre(ring: np.ndarray) -> np.ndarray:
    """The centroid of a ring's area."""
    x, y = ring.T
    cross = x * np.roll(y, -1) - np.roll(x, -1) * y
    return np.array([((x + np.roll(x, -1)) * cross).sum(), ((y + np.roll(y, -1)) * cross).sum()]) / (3 * cross.sum())


def _padded(rings: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x, y (rows by the most vertices) and the number of vertices; a row is filled up with its first vertex."""
    starts = rings.offsets.to_numpy()
    n = np.diff(starts)[rows]
    at = np.arange(max(n.max(initial=0), 1))
    index = starts[:-1][rows, None] + np.where(at < n[:, None], at, 0)
    x, y = (np.append(rings.values.field(c).to_numpy(zero_copy_only=False).astype(float), np.nan) for c in "xy")
    index = np.where(n[:, None] > 0, index, len(x) - 1)
    return x[index], y[index], n


def _areas(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Measured from each ring's first vertex, since far from the origin products lose digits."""
    x, y = x - x[:, :1], y - y[:, :1]
    return (x * np.roll(y, -1, axis=1) - y * np.roll(x, -1, axis=1)).sum(axis=1) / 2


def _centres(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x0, y0 = x[:, 0], y[:, 0]
    x, y = x - x0[:, None], y - y0[:, None]
    x2, y2 = np.roll(x, -1, axis=1), np.roll(y, -1, axis=1)
    cross = x * y2 - x2 * y
    whole = 3 * cross.sum(axis=1)
    return x0 + ((x + x2) * cross).sum(axis=1) / whole, y0 + ((y + y2) * cross).sum(axis=1) / whole


def clipped_areas(x: np.ndarray, y: np.ndarray, n: np.ndarray, wx: np.ndarray, wy: np.ndarray) -> np.ndarray:
    """Areas of rings within convex windows, row by row as clip_convex cuts them; all are filled up with their first vertex."""
    turned = _areas(wx, wy) < 0
    wx, wy = (np.where(turned[:, None], np.roll(w[:, ::-1], 1, axis=1), w) for w in (wx, wy))
    wx2, wy2 = np.roll(wx, -1, axis=1), np.roll(wy, -1, axis=1)
    for k in range(wx.shape[1]):
        px, py = wx[:, k, None], wy[:, k, None]
        side = (x - px) * (wy2[:, k, None] - py) - (y - py) * (wx2[:, k, None] - px)
        x2, y2, side2 = (np.roll(v, -1, axis=1) for v in (x, y, side))
        real = np.arange(x.shape[1]) < n[:, None]
        keep = real & (side <= 0)
        cross = real & (((side < 0) & (side2 > 0)) | ((side > 0) & (side2 < 0)))
        made = keep.astype(np.int64) + cross
        to = np.cumsum(made, axis=1) - made
        n = made.sum(axis=1)
        share = np.divide(side, side - side2, out=np.zeros_like(side), where=cross)
        shape = (len(x), max(int(n.max(initial=0)), 1))
        outs = []
        for v, v2 in ((x, x2), (y, y2)):
            out = np.zeros(shape)
            row, col = np.nonzero(keep)
            out[row, to[row, col]] = v[row, col]
            row, col = np.nonzero(cross)
            out[row, to[row, col] + keep[row, col]] = v[row, col] + (v2[row, col] - v[row, col]) * share[row, col]
            outs.append(np.where(np.arange(shape[1]) < n[:, None], out, out[:, :1]))
        x, y = outs
    return np.abs(_areas(x, y))


def overlap_measures(pairs: DataFrame) -> DataFrame:
    """pairs(..., ring, ring2), ring2 convex -> plus overlap, iou, cover (share of ring), cover2, ratio and apart (centres).

    Many pairs are clipped at once, those with as many vertices together.
    """
    kept = [c for c in pairs.columns if c not in ("ring", "ring2")]
    names = ("overlap", "iou", "cover", "cover2", "ratio", "apart")

    def measures(ring: pa.Array, ring2: pa.Array, rows: np.ndarray) -> np.ndarray:
        (x, y, n), (x2, y2, _) = _padded(ring, rows), _padded(ring2, rows)
        both, one, two = clipped_areas(x, y, n, x2, y2), np.abs(_areas(x, y)), np.abs(_areas(x2, y2))
        (cx, cy), (cx2, cy2) = _centres(x, y), _centres(x2, y2)
        return np.array([both, both / (one + two - both), both / one, both / two, one / two, np.hypot(cx - cx2, cy - cy2)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ring, ring2 = b.column("ring"), b.column("ring2")
            size = np.maximum(np.diff(ring.offsets.to_numpy()), np.diff(ring2.offsets.to_numpy()))
            order, found = np.argsort(size, kind="stable"), np.zeros((6, b.num_rows))
            ends = np.cumsum(size[order] + 1)
            cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, CLIPPED_AT_ONCE)))
            with np.errstate(divide="ignore", invalid="ignore"):
                for rows in np.split(order, cuts[1:]):
                    found[:, rows] = measures(ring, ring2, rows)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *map(pa.array, found)], [*kept, *names])

    fields = [f"{c} {pairs.schema[c].dataType.simpleString()}" for c in kept] + [f"{n} double" for n in names]
    return pairs.select(*kept, "ring", "ring2").mapInArrow(run, ", ".join(fields))


def simplify(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas and Peucker's line simplification of a closed ring, from the vertex farthest from the first; three stay."""
    if len(ring) < 4:
        return ring
    far = int(np.argmax(np.hypot(*(ring - ring[0]).T)))
    keep, todo, line = {0, far}, [(0, far), (far, len(ring))], np.vstack([ring, ring[:1]])
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        way, inner = line[b] - line[a], line[a + 1 : b] - line[a]
        size = math.hypot(*way)
        off = np.abs(inner @ np.array([-way[1], way[0]])) / size if size else np.hypot(*inner.T)
        at = int(np.argmax(off))
        if off[at] > tolerance:
            keep.add(a + 1 + at)
            todo += [(a, a + 1 + at), (a + 1 + at, b)]
    out = ring[sorted(keep)]
    return out if len(out) > 2 else ring[np.unique([0, far, int(np.argmax(np.abs((ring - ring[0]) @ np.array([-(ring[far] - ring[0])[1], (ring[far] - ring[0])[0]]))))])]


def fitted(rings: list[np.ndarray], most: int = MOST_BYTES, tolerances: tuple[float, ...] = TOLERANCES) -> tuple[list[np.ndarray], float]:
    """Rings simplified by the least tolerance whose GeoJSON fits, or else by the largest; and that tolerance."""
    for tolerance in tolerances:
        small = [simplify(r, tolerance) for r in rings]
        if len(json.dumps([[*r.tolist(), r[0].tolist()] for r in small])) <= most:
            break
    return small, tolerance


def fit_polygons(polygons: DataFrame, id_col: str, most: int = MOST_BYTES) -> DataFrame:
    """(id, rings, tolerance): each polygon simplified as far as its size asks for."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            done = [fitted([_in(r) for r in rings], most) for rings in f["rings"]]
            yield pd.DataFrame({id_col: f[id_col], "rings": [_out(r) for r, _ in done], "tolerance": [t for _, t in done]})

    kind = polygons.schema[id_col].dataType.simpleString()
    return polygons.select(id_col, "rings").mapInPandas(run, f"{id_col} {kind}, rings {RINGS}, tolerance double")


def point_buffer(x: Column, y: Column, radius: float, corners: int = 32) -> Column:
    """A regular polygon about a point."""
    turn = lambda k, f: F.lit(radius * f(2 * math.pi * k / corners))
    return F.array(*[F.struct((x + turn(k, math.cos)).alias("x"), (y + turn(k, math.sin)).alias("y")) for k in range(corners)])


def rejected(shapes: DataFrame, points: DataFrame, least: int = 10) -> DataFrame:
    """shapes(shape_id, station_id), points(shape_id, holder) in them -> shape_id of those that hold at least ``least``
    points of other stations, and more than of their own."""
    met = points.join(shapes, "shape_id")
    sums = met.groupBy("shape_id").agg(F.count_if(F.col("holder") == F.col("station_id")).alias("own"), F.count_if(F.col("holder") != F.col("station_id")).alias("foreign"))
    return sums.where((F.col("foreign") >= least) & (F.col("foreign") > F.col("own"))).select("shape_id")
