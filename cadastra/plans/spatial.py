"""Spatial operators on the embeddings table: the first two components, in kilometres, are planar points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geo
from cadastra.operators import polygons
from cadastra.operators import spatial as ops


def points(spark, d) -> DataFrame:
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    at = lambda k: F.round(F.element_at("embedding", k).cast("double") * 10000, 3)
    return e.select("vec_id", "label", at(1).alias("x"), at(2).alias("y"))


def q16_centroid_anchor(spark, d):
    """Anchor of each label: mean point, and the largest distance to it clamped to 400..3000."""
    p = points(spark, d)
    c = p.groupBy("label").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    far = p.join(c, "label").groupBy("label", "cx", "cy").agg(F.max(F.hypot(F.col("x") - F.col("cx"), F.col("y") - F.col("cy"))).alias("far"))
    return far.select(
        "label", F.round("cx", 3).alias("cx"), F.round("cy", 3).alias("cy"),
        F.round(F.least(F.greatest("far", F.lit(400.0)), F.lit(3000.0)), 2).alias("radius"),
    )


def _anchors(spark, d) -> tuple[DataFrame, DataFrame]:
    """All points as anchors that look 300 m far, and as points."""
    p = points(spark, d).withColumn("scope", F.lit(0))
    anchors = p.select("scope", F.col("vec_id").alias("anchor_id"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.lit(300.0).alias("radius"))
    others = p.select("scope", F.col("vec_id").alias("point_id"), F.col("x").alias("px"), F.col("y").alias("py"))
    return anchors, others


def q17_nearest_or_abstain(spark, d):
    return ops.nearest_two(*_anchors(spark, d), 300.0, 25.0).select("anchor_id", "point_id", F.round("dist", 3).alias("dist"))


def q18_radius_join(spark, d):
    within = ops.radius_join(*_anchors(spark, d), 300.0).where("anchor_id <> point_id")
    return within.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("dist"), 3).alias("far"))


def q44_utm_roundtrip(spark, d):
    """Geographic points near the zone's middle to metres and back."""
    p = points(spark, d).select("vec_id", (F.lit(44.0) + F.round(F.col("x") / 4000, 4)).alias("lat"), (F.lit(21.0) + F.round(F.col("y") / 4000, 4)).alias("lon"))
    x, y = geo.wgs84_to_utm(F.col("lat"), F.col("lon"))
    there = p.withColumns({"x": x, "y": y})
    lat, lon = geo.utm_to_wgs84(F.col("x"), F.col("y"))
    return there.select("vec_id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


def _boxes(p: DataFrame) -> DataFrame:
    half = 150 + F.col("vec_id") % 7 * 20
    b = p.select(
        F.col("vec_id").alias("polygon_id"), "label", (F.col("x") - half).alias("x0"), (F.col("x") + half).alias("x1"), (F.col("y") - half).alias("y0"), (F.col("y") + half).alias("y1")
    )
    v = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return b.withColumn("ring", F.array(v("x0", "y0"), v("x1", "y0"), v("x1", "y1"), v("x0", "y1")))


def q45_points_in_polygons(spark, d):
    p = points(spark, d)
    return ops.points_per_polygon(p.select(F.col("vec_id").alias("point_id"), F.col("x").alias("px"), F.col("y").alias("py")), _boxes(p), 400.0)


def q46_shoelace(spark, d):
    return _boxes(points(spark, d)).select("polygon_id", F.round(geo.signed_area(F.col("ring")), 2).alias("area"))


def _overlaps(boxes: DataFrame) -> DataFrame:
    size = lambda s: (F.col(f"x1{s}") - F.col(f"x0{s}")) * (F.col(f"y1{s}") - F.col(f"y0{s}"))
    return ops.box_pairs(boxes, 250.0).withColumn("iou", F.col("overlap") / (size("") + size("_2") - F.col("overlap")))


def q47_box_iou(spark, d):
    return _overlaps(_boxes(points(spark, d)).drop("ring")).select(F.col("polygon_id").alias("a"), F.col("polygon_id_2").alias("b"), F.round("iou", 6).alias("iou"))


def q48_voronoi_area(spark, d):
    cells = ops.voronoi_cells(points(spark, d).select(F.col("vec_id").alias("site_id"), "x", "y"))
    return cells.select("site_id", F.round("area", 3).alias("area"), F.size("ring").alias("vertices"))


def q49_greedy_matching(spark, d):
    """Greedy matching of overlapping boxes of one label."""
    found = ops.greedy_box_matching(_boxes(points(spark, d)).withColumnRenamed("label", "scope"), 1000.0)
    return found.select("left", "right", F.round("overlap", 3).alias("overlap"))


def q74_overlap_measures(spark, d):
    """Overlap measures of the boxes that meet, by the polygon clipper."""
    met = ops.box_pairs(_boxes(points(spark, d)).drop("label"), 250.0)
    found = polygons.overlap_measures(met.select(F.col("polygon_id").alias("a"), F.col("polygon_id_2").alias("b"), "ring", F.col("ring_2").alias("ring2")))
    return found.select("a", "b", *[F.round(F.col(c) + 1e-7, 4).alias(c) for c in ("overlap", "cover", "cover2", "ratio", "apart")])


def q75_wkt_boundaries(spark, d):
    """Boundaries from well-known text: boxes with a hole, and rows that are no polygons."""
    b = _boxes(points(spark, d))
    pair = lambda *xy: F.concat_ws(" ", *[F.format_string("%.3f", F.col(c) + e) for c, e in xy])
    ring = lambda e: F.concat_ws(", ", *[pair((x, e * sx), (y, e * sy)) for x, y, sx, sy in (("x0", "y0", 1, 1), ("x1", "y0", -1, 1), ("x1", "y1", -1, -1), ("x0", "y1", 1, -1), ("x0", "y0", 1, 1))])
    text = F.when(F.col("polygon_id") % 3 == 0, F.concat(F.lit("POLYGON (("), ring(0.0), F.lit("), ("), ring(50.0), F.lit("))"))).when(
        F.col("polygon_id") % 3 == 1, F.concat(F.lit("MULTIPOLYGON((("), ring(0.0), F.lit(")))"))
    ).otherwise(F.lit("POLYGON ((1 2, 3"))
    read = polygons.read_wkt(b.withColumn("wkt", text), "polygon_id", "wkt")
    return read.select("polygon_id", F.size("rings").alias("rings"), F.round(F.aggregate("rings", F.lit(0.0), lambda s, r: s + F.abs(geo.signed_area(r))), 1).alias("area"))


def q76_dissolve(spark, d):
    """Grid squares that hold a point, dissolved by label."""
    p = points(spark, d).select("label", geo.cell(F.col("x"), 500).alias("i"), geo.cell(F.col("y"), 500).alias("j")).distinct()
    at = lambda c, n: ((F.col(c) + n) * 500).cast("double")
    ring = F.array(*[F.struct(at("i", a).alias("x"), at("j", b).alias("y")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))])
    return polygons.dissolved(p.select("label", ring.alias("ring")), "label").select("label", F.round("area", 1).alias("area"), F.round("perimeter", 1).alias("perimeter"))


QUERIES = {k: v for k, v in globals().items() if k.startswith("q") and callable(v)}

P = "WITH p AS (SELECT vec_id, label, round(embedding[1]::DOUBLE * 10000, 3) AS x, round(embedding[2]::DOUBLE * 10000, 3) AS y FROM embeddings)"
PAIRS = P + """, m AS (SELECT a.vec_id AS anchor_id, b.vec_id AS point_id, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist
  FROM p a, p b WHERE a.vec_id <> b.vec_id AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 300)"""  # fmt: skip
BOXES = P + """, b AS (SELECT vec_id AS polygon_id, x - (150 + vec_id % 7 * 20) AS x0, x + (150 + vec_id % 7 * 20) AS x1,
  y - (150 + vec_id % 7 * 20) AS y0, y + (150 + vec_id % 7 * 20) AS y1 FROM p)"""  # fmt: skip

ORACLE_SQL = {
    "q16_centroid_anchor": P + """, c AS (SELECT label, avg(x) AS cx, avg(y) AS cy FROM p GROUP BY 1)
SELECT label, round(cx, 3) AS cx, round(cy, 3) AS cy, round(least(greatest(max(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))), 400.0), 3000.0), 2) AS radius
FROM p JOIN c USING (label) GROUP BY label, cx, cy""",
    "q17_nearest_or_abstain": PAIRS + """, r AS (SELECT *, row_number() OVER w AS n, lead(dist) OVER w AS nxt FROM m WINDOW w AS (PARTITION BY anchor_id ORDER BY dist, point_id))
SELECT anchor_id, CASE WHEN nxt IS NULL OR nxt - dist > 25 THEN point_id END AS point_id, CASE WHEN nxt IS NULL OR nxt - dist > 25 THEN round(dist, 3) END AS dist FROM r WHERE n = 1""",
    "q18_radius_join": PAIRS + "SELECT anchor_id, count(*) AS n, round(max(dist), 3) AS far FROM m GROUP BY 1",
    "q44_utm_roundtrip": P + "SELECT vec_id, round(44.0 + round(x / 4000, 4), 6) AS lat, round(21.0 + round(y / 4000, 4), 6) AS lon FROM p",
    "q45_points_in_polygons": BOXES + "SELECT polygon_id, count(*) AS n, sum(vec_id)::BIGINT AS total FROM b JOIN p ON x >= x0 AND x < x1 AND y >= y0 AND y < y1 GROUP BY 1",
    "q74_overlap_measures": BOXES + """, m AS (SELECT a.polygon_id AS a, c.polygon_id AS b, greatest(least(a.x1, c.x1) - greatest(a.x0, c.x0), 0) * greatest(least(a.y1, c.y1) - greatest(a.y0, c.y0), 0) AS o,
  (a.x1 - a.x0) * (a.y1 - a.y0) AS s1, (c.x1 - c.x0) * (c.y1 - c.y0) AS s2, a.x0 + a.x1 - c.x0 - c.x1 AS dx, a.y0 + a.y1 - c.y0 - c.y1 AS dy FROM b a, b c WHERE a.polygon_id < c.polygon_id)
SELECT a, b, round(o + 1e-7, 4) AS overlap, round(o / s1 + 1e-7, 4) AS cover, round(o / s2 + 1e-7, 4) AS cover2, round(s1 / s2 + 1e-7, 4) AS ratio, round(sqrt(dx * dx + dy * dy) / 2 + 1e-7, 4) AS apart FROM m WHERE o > 0""",
    "q75_wkt_boundaries": BOXES + """SELECT polygon_id, CASE WHEN polygon_id % 3 = 0 THEN 2 ELSE 1 END::INT AS rings,
  round((x1 - x0) * (y1 - y0) + CASE WHEN polygon_id % 3 = 0 THEN (x1 - x0 - 100) * (y1 - y0 - 100) ELSE 0 END, 1) AS area FROM b WHERE polygon_id % 3 <> 2""",
    "q76_dissolve": P + """, c AS (SELECT DISTINCT label, floor(x / 500)::BIGINT AS i, floor(y / 500)::BIGINT AS j FROM p),
n AS (SELECT label, i, j, (SELECT count(*) FROM c o WHERE o.label = c.label AND abs(o.i - c.i) + abs(o.j - c.j) = 1) AS near FROM c)
SELECT label, count(*) * 250000.0::DOUBLE AS area, sum(4 - near) * 500.0::DOUBLE AS perimeter FROM n GROUP BY 1""",
    "q46_shoelace": BOXES + "SELECT polygon_id, round((x1 - x0) * (y1 - y0), 2) AS area FROM b",
    "q47_box_iou": BOXES + """, m AS (SELECT a.polygon_id AS a, c.polygon_id AS b, greatest(least(a.x1, c.x1) - greatest(a.x0, c.x0), 0) * greatest(least(a.y1, c.y1) - greatest(a.y0, c.y0), 0) AS o,
  (a.x1 - a.x0) * (a.y1 - a.y0) + (c.x1 - c.x0) * (c.y1 - c.y0) AS s FROM b a, b c WHERE a.polygon_id < c.polygon_id)
SELECT a, b, round(o / (s - o), 6) AS iou FROM m WHERE o > 0""",
}
