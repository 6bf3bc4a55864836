"""Ordered operators of the extraction steps as SQL windows and array folds, on the driver tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def q19_running_index(spark, d):
    """Synthetic id: scope * 100000 plus a running index in file order."""
    w = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    c = _read(spark, d, "customer")
    return c.select("c_custkey", (F.col("c_nationkey").cast("long") * 100000 + F.row_number().over(w)).alias("station_id"))


def q20_number_reset_sections(spark, d):
    """A number not above the one before starts a section; scopes without a reset have none."""
    c = _read(spark, d, "conversations").select("conv_id", "turn", (F.length("text") % 7).alias("num"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    reset = (F.col("num") <= F.lag("num").over(w)).cast("int")
    s = c.withColumn("section", F.sum(F.coalesce(reset, F.lit(0))).over(w))
    most = F.max("section").over(Window.partitionBy("conv_id"))
    return s.select("conv_id", "turn", F.when(most > 0, F.col("section").cast("long")).alias("section"))


def q21_marker_scope(spark, d):
    """The last marker in strictly preceding rows."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    mark = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return _read(spark, d, "events").select("event_id", F.last(mark, ignorenulls=True).over(w).alias("marker"))


def q22_old_new_pair(spark, d):
    """First and last row of each number that occurs twice or more and changed."""
    at = F.struct("ts", "event_id")
    e = _read(spark, d, "events").withColumn("num", F.get_json_object("props", "$.k").cast("long"))
    g = e.groupBy("user_id", "num").agg(F.count(F.lit(1)).alias("n"), F.min_by("event_type", at).alias("old"), F.max_by("event_type", at).alias("new"))
    return g.where((F.col("n") >= 2) & (F.col("old") != F.col("new")))


def q58_carry_forward(spark, d):
    """Settlement label of a clause: its own, or that of the clause before."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_returnflag").rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("l_returnflag") != "N", F.concat_ws(":", "l_returnflag", F.col("l_partkey").cast("string")))
    rows = _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.last(own, ignorenulls=True).over(w).alias("label"))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def q59_triplets(spark, d):
    """Every three lines of a text form a row; a shorter tail is dropped."""
    lines = _read(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("ls"))
    n = F.floor(F.size("ls") / 3).cast("int")
    rows = lines.select("doc_id", "ls", F.explode(F.filter(F.sequence(F.lit(0), n), lambda i: i < n)).alias("i"))
    cell = lambda k: F.length(F.get("ls", F.col("i") * 3 + k)).cast("long")
    return rows.select("doc_id", (F.col("i") + 1).cast("long").alias("number"), cell(0).alias("a"), cell(1).alias("b"), cell(2).alias("c"))


def q60_restatement_drop(spark, d):
    """A line that equals the last kept one, letter case aside, is dropped: a fold, since it depends on what was kept."""
    docs = _read(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("ls"))
    kept = F.aggregate(
        "ls", F.array().cast("array<string>"),
        lambda a, x: F.when((F.size(a) > 0) & (F.lower(F.element_at(a, -1)) == F.lower(x)), a).otherwise(F.concat(a, F.array(x))),
    )
    return docs.select("doc_id", F.size("ls").cast("long").alias("n_lines"), F.size(kept).cast("long").alias("n_kept"))


def q61_greedy_batches(spark, d):
    """Stations in order fill batches of a budget; one that does not fit starts the next. Sequential per scope."""
    per = _read(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("links"))
    c = _read(spark, d, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    rows = c.groupBy("c_nationkey", "c_custkey").agg(F.sum(F.coalesce("links", F.lit(0))).alias("links"))
    return greedy_batches(rows, "c_nationkey", "c_custkey", "links", 40)


def greedy_batches(rows: DataFrame, scope: str, order: str, load: str, budget: int) -> DataFrame:
    """(scope, order, batch): rows go by in order and only the batch being filled is kept, so a scope may have any size."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, batch, used = object(), 0, 0
        for t in tables:
            out = []
            for s, n in zip(t.column(scope).to_pylist(), t.column(load).to_pylist(), strict=True):
                if s != last:
                    last, batch, used = s, 0, 0
                elif used > 0 and used + n > budget:
                    batch, used = batch + 1, 0
                used += n
                out.append(batch)
            yield pa.RecordBatch.from_arrays([t.column(scope), t.column(order), pa.array(out, pa.int64())], [scope, order, "batch"])

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in (scope, order)]
    return rows.select(scope, order, load).repartition(scope).sortWithinPartitions(scope, F.col(order).asc_nulls_last()).mapInArrow(run, f"{', '.join(kinds)}, batch long")


def q62_chunk_markers(spark, d):
    """Chunk number of each line: markers before it, that line's own included."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = _read(spark, d, "events")
    n = F.sum((F.col("event_type") == "error").cast("long")).over(w)
    return e.select("event_id", "user_id", n.alias("chunk")).groupBy("user_id", "chunk").agg(F.count(F.lit(1)).alias("lines"), F.min("event_id").alias("first"))


def q63_neighbours(spark, d):
    """All other stations of the same scope."""
    s = _read(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 4).alias("scope"))
    t = s.withColumnsRenamed({"s_suppkey": "other"})
    return s.join(t, "scope").where("other <> s_suppkey").groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("other").alias("total"))


QUERIES = {k: v for k, v in globals().items() if k.startswith("q") and callable(v)}

ORACLE_SQL = {
    "q19_running_index": "SELECT c_custkey, c_nationkey::BIGINT * 100000 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS station_id FROM customer",
    "q20_number_reset_sections": """WITH c AS (SELECT conv_id, turn, length(text) % 7 AS num FROM conversations),
r AS (SELECT *, CASE WHEN num <= lag(num) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS reset FROM c),
s AS (SELECT *, sum(reset) OVER (PARTITION BY conv_id ORDER BY turn) AS section FROM r)
SELECT conv_id, turn, CASE WHEN max(section) OVER (PARTITION BY conv_id) > 0 THEN section::BIGINT END AS section FROM s""",
    "q21_marker_scope": """SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS marker FROM events""",
    "q22_old_new_pair": """SELECT user_id, num, n, old, new FROM (SELECT user_id, json_extract_string(props, '$.k')::BIGINT AS num, count(*) AS n,
  first(event_type ORDER BY ts, event_id) AS old, last(event_type ORDER BY ts, event_id) AS new FROM events GROUP BY 1, 2) WHERE n >= 2 AND old <> new""",
    "q58_carry_forward": """SELECT label, count(*) AS n FROM (SELECT last_value(CASE WHEN l_returnflag <> 'N' THEN l_returnflag || ':' || l_partkey END IGNORE NULLS) OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label FROM lineitem) GROUP BY 1""",
    "q59_triplets": """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), r AS (SELECT doc_id, ls, unnest(range(0, len(ls) // 3)) AS i FROM l)
SELECT doc_id, i + 1 AS number, length(ls[i * 3 + 1]) AS a, length(ls[i * 3 + 2]) AS b, length(ls[i * 3 + 3]) AS c FROM r""",
    "q60_restatement_drop": """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, len(ls) AS n_lines, list_sum([CASE WHEN i > 1 AND lower(ls[i]) = lower(ls[i - 1]) THEN 0 ELSE 1 END FOR i IN range(1, len(ls) + 1)])::BIGINT AS n_kept FROM l""",
    "q61_greedy_batches": """WITH RECURSIVE x AS (SELECT c_nationkey, c_custkey, count(o_orderkey) AS links, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
b AS (SELECT c_nationkey, c_custkey, n, 0::BIGINT AS batch, links AS used FROM x WHERE n = 1 UNION ALL
  SELECT x.c_nationkey, x.c_custkey, x.n, CASE WHEN b.used > 0 AND b.used + x.links > 40 THEN b.batch + 1 ELSE b.batch END,
    CASE WHEN b.used > 0 AND b.used + x.links > 40 THEN x.links ELSE b.used + x.links END FROM b JOIN x ON x.c_nationkey = b.c_nationkey AND x.n = b.n + 1)
SELECT c_nationkey, c_custkey, batch FROM b""",
    "q62_chunk_markers": """SELECT user_id, chunk, count(*) AS lines, min(event_id) AS first FROM (SELECT *, sum((event_type = 'error')::INT) OVER (
  PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS chunk FROM events) GROUP BY 1, 2""",
    "q63_neighbours": """SELECT a.s_suppkey, count(*) AS n, sum(b.s_suppkey)::BIGINT AS total FROM supplier a JOIN supplier b
  ON a.s_nationkey % 4 = b.s_nationkey % 4 AND a.s_suppkey <> b.s_suppkey GROUP BY 1""",
}
