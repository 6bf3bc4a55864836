"""Filters, joins, aggregates, set operations and top-k of the serving and reporting layer, on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def q05_active_subset(spark, d):
    """Active rows (null or blank status counts as active), a case-insensitive subset, typed output."""
    o = _read(spark, d, "orders").withColumn("retired", F.when(F.col("o_orderstatus") == "F", "  ").when(F.col("o_orderstatus") == "O", "x"))
    o = o.where(F.col("retired").isNull() | (F.trim("retired") == ""))
    return o.where(F.upper("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        F.col("o_orderkey").cast("string").alias("id"), F.round("o_totalprice", 2).alias("price"), F.coalesce(F.trim("retired"), F.lit("-")).alias("flag")
    )


def q06_left_join_sentinel(spark, d):
    """Every customer with its latest order, or the sentinel -1."""
    c = _read(spark, d, "customer").select("c_custkey")
    o = _read(spark, d, "orders").where("o_totalprice > 200000").groupBy("o_custkey").agg(F.max("o_orderkey").alias("k"))
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", F.coalesce("k", F.lit(-1)).alias("last_order"))


def q07_semi_either(spark, d):
    """Nations that hold a rich customer or a rich supplier: the OR of two IN lists as a union of two semi joins."""
    n = _read(spark, d, "nation")
    c = _read(spark, d, "customer").where("c_acctbal > 9500").select(F.col("c_nationkey").alias("n_nationkey"))
    s = _read(spark, d, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey"))
    return n.join(c.unionByName(s), "n_nationkey", "left_semi").select("n_nationkey", "n_name")


def q08_anti_join(spark, d):
    return _read(spark, d, "customer").join(
        _read(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti"
    ).select("c_custkey", "c_name")


def q09_computed_key_join(spark, d):
    """An id that names either a nation or, with a prefix, a region."""
    s = _read(spark, d, "supplier").withColumn(
        "ref", F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("reg:"), (F.col("s_nationkey") % 5).cast("string"))).otherwise(F.col("s_nationkey").cast("string"))
    )
    names = _read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("ref"), F.col("n_name").alias("name")).unionByName(
        _read(spark, d, "region").select(F.concat(F.lit("reg:"), F.col("r_regionkey").cast("string")).alias("ref"), F.col("r_name").alias("name"))
    )
    return s.join(names, "ref", "left").select("s_suppkey", "ref", "name")


def q10_review_dashboard(spark, d):
    """Nation list with nested counts over a chain of left joins."""
    n, c, o = (_read(spark, d, t) for t in ("nation", "customer", "orders"))
    per = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).alias("total")
    )
    j = n.join(c, n.n_nationkey == c.c_nationkey, "left").join(per, c.c_custkey == per.o_custkey, "left")
    return j.groupBy("n_nationkey", "n_name").agg(
        F.count_distinct("c_custkey").alias("customers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("open"), F.lit(0)).alias("open_orders"), F.round(F.coalesce(F.sum("total"), F.lit(0)).cast("double"), 2).alias("total"),
    )


def q11_first_by_ordinal(spark, d):
    """The first value of each group in an explicit order, never an arbitrary one."""
    rows = _read(spark, d, "lineitem")
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rows.groupBy("l_suppkey").agg(F.min(key).alias("k")).select("l_suppkey", F.col("k.l_orderkey").alias("orderkey"), F.col("k.l_partkey").alias("partkey"))


def q12_keep_first(spark, d):
    """Distinct texts, the lowest id of each kept."""
    w = Window.partitionBy("lang", "text").orderBy("doc_id")
    docs = _read(spark, d, "documents").withColumn("n", F.row_number().over(w)).where("n = 1")
    return docs.select("doc_id", "lang", "source")


def q13_histogram(spark, d):
    share = F.col("l_discount") * 10
    return _read(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(share < 0.2).alias("low"), F.count_if((share >= 0.2) & (share < 0.5)).alias("mid"),
        F.count_if((share >= 0.5) & (share < 0.8)).alias("high"), F.count_if(share >= 0.8).alias("top"),
    )


def q14_spread(spark, d):
    return _read(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.round(F.avg(F.col("o_totalprice").cast("decimal(20,2)")).cast("double"), 2).alias("mean"), F.round(F.percentile("o_totalprice", F.lit(0.5)), 2).alias("median"),
        F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"),
    )


def q15_rates(spark, d):
    """Ratios of sums, zero where nothing is there."""
    j = _read(spark, d, "documents").join(_read(spark, d, "labels"), "doc_id", "left")
    rate = lambda a, b: F.round(F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)), 6)
    return j.groupBy("lang", "source").agg(F.count("quality").alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).select(
        "lang", "source", "n", "good", rate("good", "n").alias("good_rate"), rate("bad", "n").alias("bad_rate")
    )


def q23_search_topk(spark, d):
    """Ten suppliers and thirty parts whose name contains the query (wildcards of the input are plain characters)."""
    has = lambda c: F.upper(F.col(c)).contains("1")
    s = _read(spark, d, "supplier").where(has("s_name")).select(F.lit(0).alias("rank"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    p = _read(spark, d, "part").where(has("p_brand")).select(F.lit(1).alias("rank"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return s.orderBy("name", "id").limit(10).unionByName(p.orderBy("name", "id").limit(30))


def q24_worst_and_rank(spark, d):
    """Fifteen lowest balances of all, with their rank within their nation. The nation's rank needs all its rows."""
    w = Window.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey")
    c = _read(spark, d, "customer").withColumn("nation_rank", F.rank().over(w))
    return c.orderBy("c_acctbal", "c_custkey").limit(15).select("c_custkey", "c_nationkey", "c_acctbal", "nation_rank")


def q25_set_operations(spark, d):
    """Nations of customers only, of both, of suppliers only; INTERSECT and EXCEPT are extensions."""
    c = _read(spark, d, "customer").select(F.col("c_nationkey").alias("k"))
    s = _read(spark, d, "supplier").where("s_acctbal > 2000").select(F.col("s_nationkey").alias("k"))
    tag = lambda df, t: df.distinct().withColumn("side", F.lit(t))
    return tag(c.subtract(s), "customer").unionByName(tag(c.intersect(s), "both")).unionByName(tag(s.subtract(c), "supplier"))


def q52_next_number(spark, d):
    """Next free number of each nation over two tables of numbers."""
    a = _read(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("number"))
    b = _read(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), (F.col("s_suppkey") + 100).alias("number"))
    return a.unionByName(b).groupBy("k").agg((F.max("number") + 1).alias("next_number"))


def q53_last_write_wins(spark, d):
    """First and last event of each user and type: setdefault and overwrite of a keyed log."""
    at = F.struct("ts", "event_id")
    return _read(spark, d, "events").groupBy("user_id", "event_type").agg(
        F.min_by("event_id", at).alias("first_id"), F.max_by("event_id", at).alias("last_id")
    )


def q54_backlog_buckets(spark, d):
    n = F.col("n")
    bucket = F.when(n == 0, "0").when(n <= 25, "1-25").when(n <= 50, "26-50").when(n <= 100, "51-100").otherwise(">100")
    c, o = _read(spark, d, "customer"), _read(spark, d, "orders")
    per = c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg((F.count("o_orderkey") * 4).alias("n"))
    return per.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("customers"))


def q55_dual_vote(spark, d):
    """A document is of two scripts if half of its first five lines at least repeat the line before by length."""
    lines = _read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    w = Window.partitionBy("doc_id").orderBy("no")
    near = F.abs(F.length("line") - F.lag(F.length("line")).over(w)) <= 20
    first = lines.withColumn("hit", F.coalesce(near, F.lit(False))).where("no < 5")
    return first.groupBy("doc_id").agg((F.count_if("hit") * 2 >= F.count(F.lit(1))).alias("dual"))


def q56_evidence_union(spark, d):
    """Distinct (station, settlement) pairs from four sources, with the strongest role."""
    o, c = _read(spark, d, "orders"), _read(spark, d, "customer")
    base = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "c_nationkey")
    home = base.select((F.col("o_orderkey") % 500).alias("station"), F.col("c_nationkey").alias("settlement"), F.lit(0).alias("role"))
    span = base.where("o_orderkey % 3 = 0").select((F.col("o_orderkey") % 500).alias("station"), (F.col("o_custkey") % 25).cast("int").alias("settlement"), F.lit(1).alias("role"))
    return home.unionByName(span).groupBy("station", "settlement").agg(F.when(F.min("role") == 0, "home").otherwise("spanned").alias("role"))


def q57_row_signature(spark, d):
    """Content hash of a row over a separator, nulls marked."""
    c = _read(spark, d, "customer")
    cols = [F.coalesce(F.col(x).cast("string"), F.lit("\\N")) for x in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")]
    return c.select("c_custkey", F.sha2(F.concat_ws("\x1f", *cols), 256).alias("sig"))


def ext_rollup(spark, d):
    """Extension: rollup over two flags."""
    return _read(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.grouping_id().cast("long").alias("level")
    )


def ext_cube(spark, d):
    """Extension: cube over two keys."""
    return _read(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def ext_tumbling(spark, d):
    """Extension: events by day and type."""
    e = _read(spark, d, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return e.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def ext_sliding(spark, d):
    """Extension: two-hour windows every hour."""
    e = _read(spark, d, "events").groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))
    return e.select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "n", "users")


def ext_sessions(spark, d):
    """Extension: sessions of a user with gaps of four hours."""
    e = _read(spark, d, "events").groupBy("user_id", F.session_window("ts", "4 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return e.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


QUERIES = {k: v for k, v in globals().items() if k.startswith(("q0", "q1", "q2", "q5", "ext_")) and callable(v)}

ORACLE_SQL = {
    "q05_active_subset": """SELECT o_orderkey::VARCHAR AS id, round(o_totalprice, 2) AS price, CASE WHEN o_orderstatus = 'F' THEN '' ELSE '-' END AS flag
FROM orders WHERE o_orderstatus <> 'O' AND upper(o_orderpriority) IN ('1-URGENT', '2-HIGH')""",
    "q06_left_join_sentinel": """SELECT c_custkey, coalesce(k, -1)::BIGINT AS last_order FROM customer
LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_totalprice > 200000 GROUP BY 1) ON c_custkey = o_custkey""",
    "q07_semi_either": """SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9500)
OR n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)""",
    "q08_anti_join": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
    "q09_computed_key_join": """WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'reg:' || (s_nationkey % 5)::VARCHAR ELSE s_nationkey::VARCHAR END AS ref FROM supplier)
SELECT s_suppkey, ref, coalesce(n_name, r_name) AS name FROM s LEFT JOIN nation ON ref = n_nationkey::VARCHAR LEFT JOIN region ON ref = 'reg:' || r_regionkey::VARCHAR""",
    "q10_review_dashboard": """WITH per AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS op, sum(o_totalprice::DECIMAL(20,2)) AS t FROM orders GROUP BY 1)
SELECT n_nationkey, n_name, count(DISTINCT c_custkey) AS customers, coalesce(sum(n), 0)::BIGINT AS orders, coalesce(sum(op), 0)::BIGINT AS open_orders,
  round(coalesce(sum(t), 0)::DOUBLE, 2) AS total FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN per ON o_custkey = c_custkey GROUP BY 1, 2""",
    "q11_first_by_ordinal": """SELECT l_suppkey, l_orderkey AS orderkey, l_partkey AS partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) = 1""",
    "q12_keep_first": "SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1",
    "q13_histogram": """SELECT l_returnflag, count(*) FILTER (l_discount * 10 < 0.2) AS low, count(*) FILTER (l_discount * 10 >= 0.2 AND l_discount * 10 < 0.5) AS mid,
  count(*) FILTER (l_discount * 10 >= 0.5 AND l_discount * 10 < 0.8) AS high, count(*) FILTER (l_discount * 10 >= 0.8) AS top FROM lineitem GROUP BY 1""",
    "q14_spread": """SELECT o_orderpriority, round((sum(o_totalprice::DECIMAL(20,2)) / count(*))::DOUBLE, 2) AS mean, round(quantile_cont(o_totalprice, 0.5), 2) AS median,
  min(o_totalprice) AS least, max(o_totalprice) AS most FROM orders GROUP BY 1""",
    "q15_rates": """SELECT lang, source, count(quality) AS n, coalesce(sum(quality), 0)::BIGINT AS good,
  round(CASE WHEN count(quality) > 0 THEN sum(quality) / count(quality) ELSE 0.0 END, 6)::DOUBLE AS good_rate,
  round(CASE WHEN count(quality) > 0 THEN sum(toxic) / count(quality) ELSE 0.0 END, 6)::DOUBLE AS bad_rate
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2""",
    "q23_search_topk": """(SELECT 0 AS rank, s_suppkey AS id, s_name AS name FROM supplier WHERE contains(upper(s_name), '1') ORDER BY name, id LIMIT 10)
UNION ALL (SELECT 1 AS rank, p_partkey AS id, p_name AS name FROM part WHERE contains(upper(p_brand), '1') ORDER BY name, id LIMIT 30)""",
    "q24_worst_and_rank": """SELECT c_custkey, c_nationkey, c_acctbal, nation_rank::INT AS nation_rank FROM (
  SELECT *, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS nation_rank FROM customer) ORDER BY c_acctbal, c_custkey LIMIT 15""",
    "q25_set_operations": """WITH c AS (SELECT c_nationkey AS k FROM customer), s AS (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 2000)
SELECT k, 'customer' AS side FROM (SELECT * FROM c EXCEPT SELECT * FROM s) UNION ALL SELECT k, 'both' FROM (SELECT * FROM c INTERSECT SELECT * FROM s)
UNION ALL SELECT k, 'supplier' FROM (SELECT * FROM s EXCEPT SELECT * FROM c)""",
    "q52_next_number": """SELECT k, max(number) + 1 AS next_number FROM (SELECT c_nationkey AS k, c_custkey AS number FROM customer
UNION ALL SELECT s_nationkey, s_suppkey + 100 FROM supplier) GROUP BY 1""",
    "q53_last_write_wins": """SELECT user_id, event_type, first(event_id ORDER BY ts, event_id) AS first_id, last(event_id ORDER BY ts, event_id) AS last_id FROM events GROUP BY 1, 2""",
    "q54_backlog_buckets": """SELECT CASE WHEN n = 0 THEN '0' WHEN n <= 25 THEN '1-25' WHEN n <= 50 THEN '26-50' WHEN n <= 100 THEN '51-100' ELSE '>100' END AS bucket, count(*) AS customers
FROM (SELECT c_custkey, count(o_orderkey) * 4 AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1) GROUP BY 1""",
    "q55_dual_vote": """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), f AS (SELECT doc_id, least(len(ls), 5) AS n,
  list_sum([CASE WHEN i > 1 AND abs(length(ls[i]) - length(ls[i - 1])) <= 20 THEN 1 ELSE 0 END FOR i IN range(1, least(len(ls), 5) + 1)]) AS hits FROM l)
SELECT doc_id, hits * 2 >= n AS dual FROM f""",
    "q56_evidence_union": """WITH base AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey), e AS (
  SELECT o_orderkey % 500 AS station, c_nationkey AS settlement, 0 AS role FROM base UNION ALL
  SELECT o_orderkey % 500, (o_custkey % 25)::INT, 1 FROM base WHERE o_orderkey % 3 = 0)
SELECT station, settlement, CASE WHEN min(role) = 0 THEN 'home' ELSE 'spanned' END AS role FROM e GROUP BY 1, 2""",
    "q57_row_signature": """SELECT c_custkey, sha256(concat_ws(chr(31), coalesce(c_custkey::VARCHAR, '\\N'), coalesce(c_name, '\\N'), coalesce(c_nationkey::VARCHAR, '\\N'), coalesce(c_mktsegment, '\\N'))) AS sig FROM customer""",
    "ext_rollup": """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity, grouping(l_returnflag, l_linestatus)::BIGINT AS level
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "ext_cube": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "ext_tumbling": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "ext_sliding": """SELECT strftime(w, '%Y-%m-%d %H:%M') AS start, count(*) AS n, count(DISTINCT user_id) AS users FROM (
  SELECT user_id, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM events) GROUP BY w""",
    "ext_sessions": """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, sid""",
}
