"""Edit logs, deltas and sinks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import predicates
from cadastra.functions.grammar import NUMBER_LISTS
from cadastra.functions.house import interval_parity
from cadastra.operators import edits as ops
from cadastra.sources.sinks import update_statements


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _versions(spark, d):
    o = _read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    old = o.where("o_orderkey % 11 <> 0")
    new = o.where("o_orderkey % 13 <> 0").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return old, new


def q38_delta_actions(spark, d):
    old, new = _versions(spark, d)
    return ops.delta(old, new, "o_orderkey", ["o_custkey", "o_orderstatus", "o_totalprice"])


def q39_scoped_merge(spark, d):
    old, new = _versions(spark, d)
    affected = _read(spark, d, "customer").where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("o_custkey"))
    out = ops.scoped_merge(old, new, affected, "o_custkey")
    return out.select("o_orderkey", "o_custkey", "o_totalprice")


def q40_reconcile_edits(spark, d):
    s = _read(spark, d, "supplier").select(F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("raw_coverage_text"))
    texts = _read(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("station_id"), F.concat(F.lit("new "), "c_name").alias("raw_coverage_text"))
    added = _read(spark, d, "nation").select((F.col("n_nationkey").cast("long") + 9_500_000).alias("station_id"), F.col("n_name").alias("raw_coverage_text"))
    removed = s.where("station_id % 4 = 1").select("station_id").unionByName(added.where("station_id % 10 = 0").select("station_id"))
    return ops.reconcile(s, texts, added, removed)


def q41_upsert_greatest(spark, d):
    c = _read(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 3).alias("reviewed"), F.col("c_name").alias("note"))
    e = _read(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max(F.col("o_orderkey") % 5).alias("reviewed"), F.min("o_orderpriority").alias("note"))
    return ops.upsert_greatest(c, e, "id", ["reviewed"], ["note"])


def q42_json_blobs(spark, d):
    """One JSON array of stations for each scope, by number, with the scope's count."""
    c = _read(spark, d, "customer").select("c_nationkey", F.struct(F.col("c_custkey").alias("number"), F.col("c_mktsegment").alias("name")).alias("s"))
    g = c.groupBy("c_nationkey").agg(F.to_json(F.array_sort(F.collect_list("s"))).alias("blob"), F.count(F.lit(1)).alias("n"))
    return g.select("c_nationkey", "n", F.md5(F.encode("blob", "utf-8")).alias("etag"))


def q43_geojson_features(spark, d):
    """A Feature for each supplier: point geometry and properties."""
    s = _read(spark, d, "supplier")
    at = F.array(F.round(F.lit(20.0) + F.col("s_nationkey") / 10, 1), F.round(F.lit(44.0) + F.col("s_suppkey") % 10 / 10, 1))
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), at.alias("coordinates")).alias("geometry"),
        F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).alias("properties"),
    ))
    return s.select("s_suppkey", feature.alias("feature"))


def q64_clear_unchanged(spark, d):
    e = _read(spark, d, "events")
    snapshot = ops.last_write(e.where("ts < TIMESTAMP '2024-01-15'"), "user_id", ["ts", "event_id"])
    dirty = ops.last_write(e, "user_id", ["ts", "event_id"])
    return ops.clear_unchanged(dirty, snapshot, "user_id", "ts").select("user_id", "event_id")


def q65_change_classes(spark, d):
    pick = lambda cond: _read(spark, d, "orders").where(cond).select(F.col("o_custkey").alias("station_id"))
    return ops.change_classes(pick("o_orderkey % 17 = 0"), pick("o_orderkey % 5 = 0"), pick("o_orderkey % 2 = 0"))


def q66_strip_reason(spark, d):
    k = F.col("o_orderkey")
    reasons = F.array_compact(F.array(F.when(k % 2 == 0, "fuzzy"), F.when(k % 3 == 0, "osm_fallback"), F.when(k % 5 == 0, "no_match")))
    out = ops.strip_reason(reasons, "osm_fallback", "street_unresolved")
    return _read(spark, d, "orders").groupBy(F.concat_ws(",", out).alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


def q67_amendments(spark, d):
    """A renamed street, a replaced range, a number added under the new name, and one for a street that is not there."""
    n = F.col("l_linenumber").cast("long")
    lines = _read(spark, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    whole = f"struct<{NUMBER_LISTS}>"
    interval = F.struct(n.alias("lo"), (n + 10).alias("hi"), interval_parity(n, n + 10).alias("parity"), F.lit("").alias("lo_sfx"), F.lit("").alias("hi_sfx"))
    coverage = F.struct(F.array(interval).alias("intervals"), F.array(F.struct(F.col("p").alias("num"), F.lit("").alias("suffix"))).alias("singles")).cast(whole)
    segs = lines.select(F.col("l_suppkey").alias("station_id"), n.alias("seg_id"), F.concat(F.lit("Пут S"), n.cast("string")).alias("street"), coverage.alias("c"))
    segs = segs.select("station_id", "seg_id", "street", "c.*", F.lit(False).alias("whole"))
    op = lambda doc, bullet, *rest: F.struct(*[F.lit(x).alias(c) for c, x in zip(("doc", "bullet", "op", "street", "old", "new"), (doc, bullet, *rest), strict=True)])
    asked = F.array(
        op(2, 1, "add_house", "Нови", "", "5а"), op(1, 1, "fix_street_name", "Пут S1", "Пут S1", "Нови пут"),
        op(1, 2, "replace_range", "Пут S2", "2-12, 999999", "2-8, 11 и 13"), op(3, 1, "add_house", "Ливаде", "", "7"), op(3, 2, "other", "Пут S3", "", ""),
    )
    ops_ = lines.select(F.col("l_suppkey").alias("station_id")).distinct().select("station_id", F.explode(asked).alias("o")).select("station_id", "o.*")
    text = lambda c, f: F.array_join(F.transform(c, f), ",")
    return ops.apply_amendments(segs, ops_).select(
        "station_id", "seg_id", "street", text("intervals", lambda i: F.concat(i["lo"].cast("string"), F.lit("-"), i["hi"].cast("string"))).alias("intervals"),
        text("singles", lambda x: F.concat(x["num"].cast("string"), x["suffix"])).alias("singles"), "amended",
    )


def q72_predicates(spark, d):
    """Coverage, weak matches, causes, JSON with a default and value differences on orders."""
    o = _read(spark, d, "orders")
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    some = lambda m: F.when(k % m == 0, F.array(k)).otherwise(F.array().cast("array<bigint>"))
    fuzzy, name = F.when(k % 2 == 0, "fuzzy").otherwise("exact"), F.when(k % 3 == 0, F.lit("БРДО")).otherwise(F.lit("НОВО БРДО"))
    share = lambda m: (k % m).cast("double") / m
    made = F.when(k % 3 == 0, F.concat(F.lit('{"lo":'), k.cast("string"), F.lit("}"))).when(k % 3 == 1, F.lit("{lo:")).otherwise(F.lit(None).cast("string"))
    return o.select(
        "o_orderkey", predicates.has_coverage(k % 5 == 0, some(7), some(11), F.lit(None)).alias("covers"),
        predicates.weak_substring(fuzzy, name, F.lit("ГОРЊЕ БРДО")).alias("weak"),
        predicates.cause(share(10), share(7) * 2, share(3) + 0.1, share(4) + 0.1, price % 800).alias("cause"),
        predicates.json_or(made, "struct<lo:bigint>", F.struct(F.lit(-1).cast("long").alias("lo")))["lo"].alias("lo"),
        F.array_join(F.transform(predicates.without_values(F.array(k % 4, k % 3, k % 4, F.lit(9)), F.array(F.lit(1).cast("long"), k % 2)), lambda x: x.cast("string")), ",").alias("left_over"),
        predicates.iso_utc(F.timestamp_seconds(k)).alias("stamp"),
    )


def q73_update_statements(spark, d):
    return update_statements(_read(spark, d, "nation"), "nation", "n_nationkey", ["n_name", "n_regionkey"])


QUERIES = {k: v for k, v in globals().items() if k.startswith("q") and callable(v)}

V = """WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders), old AS (SELECT * FROM o WHERE o_orderkey % 11 <> 0),
new AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM o WHERE o_orderkey % 13 <> 0)"""

ORACLE_SQL = {
    "q67_amendments": """WITH l AS (SELECT l_suppkey AS s, l_linenumber::BIGINT AS n, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2),
r AS (SELECT s AS station_id, n AS seg_id, CASE WHEN n = 1 THEN 'Нови пут' ELSE 'Пут S' || n END AS street, CASE WHEN n = 2 THEN '2-8' ELSE n || '-' || (n + 10) END AS intervals,
  p || CASE WHEN n = 1 THEN ',5А' WHEN n = 2 THEN ',11,13' ELSE '' END AS singles, n <= 2 AS amended FROM l)
SELECT * FROM r UNION ALL SELECT s, max(n) + 1, 'Ливаде', '', '7', true FROM l GROUP BY s""",
    "q72_predicates": """SELECT o_orderkey, o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 AS covers, o_orderkey % 6 = 0 AS weak,
CASE WHEN o_orderkey % 3 / 3 + 0.1::DOUBLE >= 0.7 AND o_orderkey % 7 / 7 * 2 < 0.6 THEN 'ours_much_smaller' WHEN o_orderkey % 4 / 4 + 0.1::DOUBLE >= 0.7 AND o_orderkey % 7 / 7 * 2 > 1.6 THEN 'ours_much_larger'
  WHEN o_totalprice::DOUBLE % 800 > 400 THEN 'centres_apart' WHEN o_orderkey % 10 / 10 < 0.2 THEN 'little_shared' ELSE 'partial_shift' END AS cause,
CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE -1 END AS lo,
array_to_string([x FOR x IN [o_orderkey % 4, o_orderkey % 3, o_orderkey % 4, 9] IF x <> 1 AND x <> o_orderkey % 2], ',') AS left_over,
strftime(make_timestamp(o_orderkey * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS stamp FROM orders""",
    "q73_update_statements": "SELECT n_nationkey, 'UPDATE nation SET n_name=''' || n_name || ''', n_regionkey=' || n_regionkey || ' WHERE n_nationkey=' || n_nationkey || ';' AS statement FROM nation",
    "q38_delta_actions": V + """ SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS action
FROM old a FULL JOIN new b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice""",
    "q39_scoped_merge": V + """ SELECT o_orderkey, o_custkey, o_totalprice FROM old WHERE o_custkey % 5 <> 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM new WHERE o_custkey % 5 = 0 AND o_custkey IN (SELECT c_custkey FROM customer)""",
    "q40_reconcile_edits": """WITH s AS (SELECT s_suppkey AS station_id, s_name AS t FROM supplier), a AS (SELECT n_nationkey::BIGINT + 9500000 AS station_id, n_name AS t FROM nation),
u AS (SELECT * FROM s WHERE station_id % 4 <> 1 UNION ALL SELECT * FROM a WHERE station_id % 10 <> 0)
SELECT station_id, coalesce('new ' || c_name, t) AS raw_coverage_text FROM u LEFT JOIN customer ON c_custkey = station_id AND c_custkey % 3 = 0""",
    "q41_upsert_greatest": """WITH c AS (SELECT c_custkey AS id, c_custkey % 3 AS r, c_name AS note FROM customer WHERE c_custkey % 2 = 0),
e AS (SELECT o_custkey AS id, max(o_orderkey % 5) AS r, min(o_orderpriority) AS note FROM orders GROUP BY 1)
SELECT coalesce(c.id, e.id) AS id, greatest(c.r, e.r) AS reviewed, coalesce(e.note, c.note) AS note FROM c FULL JOIN e ON c.id = e.id""",
    "q42_json_blobs": """SELECT c_nationkey, count(*) AS n, md5('[' || string_agg('{"number":' || c_custkey || ',"name":"' || c_mktsegment || '"}', ',' ORDER BY c_custkey) || ']') AS etag
FROM customer GROUP BY 1""",
    "q43_geojson_features": """SELECT s_suppkey, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || round(20.0 + s_nationkey / 10, 1)::DOUBLE || ',' || round(44.0 + s_suppkey % 10 / 10, 1)::DOUBLE
|| ']},"properties":{"id":' || s_suppkey || ',"name":"' || s_name || '"}}' AS feature FROM supplier""",
    "q64_clear_unchanged": """WITH l AS (SELECT user_id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id FROM l WHERE ts >= TIMESTAMP '2024-01-15'""",
    "q65_change_classes": """SELECT o_custkey AS station_id, CASE min(CASE WHEN o_orderkey % 17 = 0 THEN 0 WHEN o_orderkey % 5 = 0 THEN 1 ELSE 2 END) WHEN 0 THEN 'segments' WHEN 1 THEN 'links' ELSE 'polygons' END AS change
FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 2 = 0 GROUP BY 1""",
    "q66_strip_reason": """WITH r AS (SELECT o_orderkey AS k FROM orders)
SELECT CASE WHEN k % 2 <> 0 AND k % 5 <> 0 AND k % 3 = 0 THEN 'street_unresolved' ELSE concat_ws(',', CASE WHEN k % 2 = 0 THEN 'fuzzy' END, CASE WHEN k % 5 = 0 THEN 'no_match' END) END AS reasons,
count(*) AS n FROM r GROUP BY 1""",
}
