"""Steps that must grow with their input: what joins and groups make, on tables that repeat their names."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions.house import suffix_rank
from cadastra.operators import claims, polygons, resolve, spatial
from cadastra.plans import windows
from cadastra.plans.registry import ORACLE_SQL, QUERIES
from cadastra.sources import readers

D = "/root/testdata/sf0.001"


def nodes(plan):
    """All nodes of an executed plan, through adaptive stages."""
    kind = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
    return [(kind, plan), *[n for p in inner for n in nodes(p)]]


def joins(df):
    """(number of keys, rows made) of every join of a query that has run."""
    df.collect()
    return [(p.leftKeys().size(), p.metrics().apply("numOutputRows").value()) for kind, p in nodes(df._jdf.queryExecution().executedPlan()) if kind.endswith("JoinExec")]


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """sf0.001 three times over with shifted keys, so that names come in threes."""
    d = tmp_path_factory.mktemp("copies")
    con = duckdb.connect()
    for t, keys in {"supplier": "s_suppkey", "customer": "c_custkey", "part": "p_partkey", "orders": "o_orderkey o_custkey", "lineitem": "l_orderkey l_partkey l_suppkey"}.items():
        moved = ", ".join(f"{k} + i * 1000003 AS {k}" for k in keys.split())
        con.execute(f"COPY (SELECT {moved}, * EXCLUDE ({', '.join(keys.split())}, i) FROM '{D}/{t}.parquet', range(3) r(i)) TO '{d}/{t}.parquet' (FORMAT parquet)")
    return str(d)


def agree(spark, d, name):
    con = duckdb.connect()
    for t in ("supplier", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = QUERIES[name](spark, d)
    cols = ", ".join(f'"{c}"' for c in df.columns)
    want = sorted(map(repr, con.execute(f"SELECT {cols} FROM ({ORACLE_SQL[name]})").fetchall()))
    assert sorted(repr(tuple(r)) for r in df.collect()) == want and want
    return df


def test_one_edit_meets_by_keys(spark, copies):
    assert min(k for k, _ in joins(agree(spark, copies, "q30_one_edit"))) >= 2
    names = ["", "a", "b", "ab", "ba", "abc", "acb", "bca", "aab", "aabb", "abab", "Ж", "ЖЗ", "ЗЖ", None]
    df = spark.createDataFrame([(0, n) for n in names], "s int, x string")
    got = {(r.x, r.y) for r in resolve.one_edit_pairs(df, df.withColumnRenamed("x", "y"), "s").collect()}
    assert got == {(a, b) for a in names for b in names if a is not None and b is not None and near(a, b)}


def near(a, b):
    cut = lambda s: {s[:i] + s[i + 1 :] for i in range(len(s))}
    swap = {a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1)}
    put = len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    return put or b in swap or a in cut(b) or b in cut(a)


def test_digit_guard_counts_without_pairs(spark, copies):
    assert max(n for _, n in joins(agree(spark, copies, "q27_digit_guard"))) <= 3000


def test_token_subset_meets_by_words(spark, copies):
    assert min(k for k, _ in joins(agree(spark, copies, "q31_token_subset"))) >= 2


def test_token_subset_of_odd_rows(spark, tmp_path):
    rows = [(1, "A", "x y"), (2, "A", "y x z"), (2, "A", "x"), (3, "A", "x x"), (4, "A", ""), (5, "B", "x"), (None, "A", "x"), (6, None, "x"), (7, "A", None), (8, "A", "x y")]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.p_partkey: r.n for r in QUERIES["q31_token_subset"](spark, str(tmp_path)).collect()}
    kept = [(k, b, set(n.split(" "))) for k, b, n in rows if None not in (k, b, n)]
    want = {}
    for k, b, w in kept:
        if n := sum(b == c and k != j and w <= v for j, c, v in kept):
            want[k] = want.get(k, 0) + n
    assert got == want


def dealt(df):
    """Rows that a query has written to shuffles, counted after it has run."""
    df.collect()
    return sum(p.metrics().apply("shuffleRecordsWritten").value() for kind, p in nodes(df._jdf.queryExecution().executedPlan()) if kind == "ShuffleExchangeExec")


@pytest.fixture(scope="module")
def dense(spark, tmp_path_factory):
    """300 points on a few hundred metres: nearly all boxes overlap."""
    d = str(tmp_path_factory.mktemp("dense"))
    rows = [(i, [(i * 7919 % 301) / 10000, (i * 104729 % 307) / 10000], i % 3) for i in range(300)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    return d


def spatial_agrees(spark, d, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet/*.parquet'")
    df = QUERIES[name](spark, d)
    cols = ", ".join(f'"{c}"' for c in df.columns)
    plain = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    want = sorted(map(repr, map(plain, con.execute(f"SELECT {cols} FROM ({ORACLE_SQL[name]})").fetchall())))
    assert sorted(repr(plain(r)) for r in df.collect()) == want and want
    return df


def test_box_pairs_are_not_shuffled(spark, dense):
    assert dealt(spatial_agrees(spark, dense, "q47_box_iou")) <= 20 * 300


def test_rings_go_with_their_boxes(spark, dense):
    assert dealt(spatial_agrees(spark, dense, "q74_overlap_measures")) <= 20 * 300


def test_many_pairs_are_clipped_as_one(spark):
    rng = np.random.default_rng(3)
    turn = lambda n: np.sort(rng.random(n)) * 2 * np.pi
    shape = lambda n: (rng.random(2) * 2 + np.column_stack([np.cos(t := turn(n)), np.sin(t)]))[:: rng.choice([-1, 1])]
    pairs = [(shape(rng.integers(3, 9)), shape(rng.integers(3, 7))) for _ in range(300)] + [(shape(4), shape(4) + 9)]
    as_rows = lambda r: [{"x": float(x), "y": float(y)} for x, y in r]
    df = spark.createDataFrame([(i, as_rows(a), as_rows(b)) for i, (a, b) in enumerate(pairs)], f"i int, ring {polygons.RING}, ring2 {polygons.RING}")
    got = {r.i: r for r in polygons.overlap_measures(df).collect()}
    for i, (a, b) in enumerate(pairs):
        one, two = abs(polygons.signed_area(a)), abs(polygons.signed_area(b))
        both = abs(polygons.signed_area(polygons.clip_convex(a, b)))
        want = (both, both / (one + two - both), both / one, both / two, one / two, float(np.hypot(*(polygons.centre(a) - polygons.centre(b)))))
        assert np.allclose([got[i][c] for c in ("overlap", "iou", "cover", "cover2", "ratio", "apart")], want)


def test_nearest_two_do_not_make_pairs(spark, dense):
    df = spatial_agrees(spark, dense, "q17_nearest_or_abstain")
    assert not joins(df) and dealt(df) <= 10 * 300


def test_nearest_two_like_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = [(i % 2, i, float(x), float(y), float(r)) for i, ((x, y), r) in enumerate(zip(np.round(rng.normal(0, 300, (400, 2)), -1), rng.integers(20, 200, 400), strict=True))] + [(0, 900, 9e5, 0.0, 200.0)]
    a = spark.createDataFrame(rows, "scope int, anchor_id long, ax double, ay double, radius double")
    p = a.selectExpr("scope", "anchor_id AS point_id", "ax AS px", "ay AS py")
    want = spatial.nearest_or_abstain(spatial.radius_join(a, p, 200.0).where("anchor_id <> point_id"), 10.0)
    assert sorted(spatial.nearest_two(a, p, 200.0, 10.0).collect()) == sorted(want.collect()) != []


def test_voronoi_cells_look_near_them(spark):
    rng = np.random.default_rng(7)
    places = np.vstack([rng.normal(0, 60, (250, 2)), rng.normal(0, 900, (60, 2)), [[9e5, 0.0]]])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(places)], "site_id long, x double, y double")
    found = spatial.voronoi_cells(df)
    got = {r.site_id: r for r in found.collect()}
    assert not joins(found) and len(got) == len(places)
    for i, site in enumerate(places):
        ring = spatial._octagon(site, spatial.CELL_RADIUS)
        for o in np.delete(places, i, axis=0):
            ring = spatial.clip_half_plane(ring, (site + o) / 2, o - site)
        assert len(got[i].ring) == len(ring) and np.isclose(got[i].area, abs(polygons.signed_area(ring)))


def test_points_are_counted_within_cells(spark, dense):
    df = spatial_agrees(spark, dense, "q45_points_in_polygons")
    assert not joins(df) and dealt(df) <= 20 * 300


def test_points_per_polygon_like_pairs(spark):
    rng = np.random.default_rng(9)
    rings = [[{"x": float(x), "y": float(y)} for x, y in np.round(rng.random((rng.integers(3, 9), 2)) * 60 + rng.random(2) * 200 - 100)] for _ in range(120)]
    polys = spark.createDataFrame([*enumerate(rings), (500, [])], f"polygon_id int, ring {polygons.RING}")
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(np.round(rng.random((800, 2)) * 300 - 150))] + [(900, None, 0.0)], "point_id long, px double, py double")
    want = spatial.points_in_polygons(points, polys, 25.0).groupBy("polygon_id").agg({"*": "count", "point_id": "sum"})
    assert sorted(map(tuple, spatial.points_per_polygon(points, polys, 25.0).collect())) == sorted((r[0], r["count(1)"], r["sum(point_id)"]) for r in want.collect()) != []


def test_greedy_matching_in_rounds(spark):
    rng = np.random.default_rng(11)
    corner = np.round(rng.random((240, 2)) * 300 - 150)
    boxes = spark.createDataFrame([(i % 2, i, x, x + w, y, y + w) for i, ((x, y), w) in enumerate(zip(corner.tolist(), rng.choice([40.0, 60.0], 240).tolist(), strict=True))], "scope int, polygon_id long, x0 double, x1 double, y0 double, y1 double")
    pairs = spatial.box_pairs(boxes, 50.0, "scope").selectExpr("scope", "polygon_id AS left", "polygon_id_2 AS right", "overlap")
    used, want = set(), []
    for p in sorted(pairs.collect(), key=lambda p: (-p.overlap, p.left, p.right)):
        if not used & {(p.scope, "l", p.left), (p.scope, "r", p.right)}:
            used |= {(p.scope, "l", p.left), (p.scope, "r", p.right)}
            want.append(tuple(p))
    for found in (spatial.greedy_matching(pairs), spatial.greedy_box_matching(boxes, 50.0)):
        assert sorted(map(tuple, found.collect())) == sorted(want) != []
        assert "InPandas" not in found._jdf.queryExecution().toString()


def test_pages_are_read_in_many_tasks(spark):
    df = spark.createDataFrame([(i, f"<table><tr><td>{i}<td>a<td>b<td>c</table>") for i in range(40)], "k int, html string").coalesce(1)
    found = readers.html_rows(df, "k", "html")
    assert found.rdd.getNumPartitions() > 1 and sorted(r.number for r in found.collect()) == list(range(40))


def test_batches_go_by_in_order(spark, copies):
    df = agree(spark, copies, "q61_greedy_batches")
    assert "aggregate(" not in df._jdf.queryExecution().optimizedPlan().toString() and "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_batches_over_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.createDataFrame([(s, i, i * 7 % 19) for s in (1, 2, 3) for i in range(50)], "s int, i long, n long")
        got = {(r.s, r.i): r.batch for r in windows.greedy_batches(rows, "s", "i", "n", 20).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    batch = used = 0
    for i in range(50):
        if used > 0 and used + i * 7 % 19 > 20:
            batch, used = batch + 1, 0
        used += i * 7 % 19
        assert got[1, i] == got[2, i] == got[3, i] == batch


@pytest.mark.parametrize("name", ["q01_claim_arbitration", "q02_parity_unconfirmed", "q03_conflict_opponents", "q51_station_points"])
def test_wide_claims_do_not_meet_every_house(spark, copies, name):
    df = agree(spark, copies, name)
    assert max(n for _, n in joins(df)) <= 3 * spark.read.parquet(f"{copies}/lineitem.parquet").count()


def test_house_claims_like_matches(spark):
    rng = np.random.default_rng(13)
    pick = lambda *xs: xs[rng.integers(len(xs))]
    rank = lambda c: suffix_rank(F.col(c))
    rows = [(i, int(rng.integers(4)), pick(None, *range(1, 40)), pick("", "А", "Б")) for i in range(300)]
    h = spark.createDataFrame(rows, "address_id long, street_id int, house_num int, suffix string").withColumn("rank", rank("suffix"))
    kinds = [pick("whole", "sett_whole", "bez_broja", "single", "single", "interval", "interval") for _ in range(40)]
    made = [(int(rng.integers(5)), i, i // 2, int(rng.integers(4)), k, lo := int(rng.integers(1, 30)), lo + 9, pick("all", "odd", "even"), pick("", "А"), "", lo, pick("", "А")) for i, k in enumerate(kinds)]
    c = spark.createDataFrame(made, "street_id int, claim_no long, seg_id long, station_id long, kind string, lo int, hi int, parity string, lo_sfx string, hi_sfx string, num int, num_suffix string")
    c = c.withColumns({"lo_rank": rank("lo_sfx"), "hi_rank": rank("hi_sfx")})
    m = claims.claim_matches(h, c)
    same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect())) != []
    assert same(claims.arbitrate_houses(h, c), claims.arbitrate(m)) and same(claims.house_conflicts(h, c), claims.conflicts(m))
    sums = claims.station_points(h, c).groupBy("station_id").agg(F.count(F.lit(1)).alias("points"), F.sum("seg_id").alias("seg_sum"))
    assert same(claims.station_sums(h, c), sums)
