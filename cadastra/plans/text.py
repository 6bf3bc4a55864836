"""Names and grammar on the driver tables: keys, guards, edit distance, the ladder, coverage texts, HTML, collation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cadastra.functions import grammar, similarity, text
from cadastra.operators import resolve as ladder
from cadastra.sources.readers import html_rows


def _read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _roman_of(c):
    return F.create_map(*[F.lit(x) for n in range(1, 51) for x in (n, text.roman(n) if n < 40 else "XL" + text.roman(n - 40))])[c]


def q26_normalize_key(spark, d):
    p = _read(spark, d, "part")
    name = F.concat(F.lit("  улица: "), F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit("), Ј.Н.А. "), _roman_of(F.col("p_size")))
    return p.select("p_partkey", text.normalize_street(name).alias("key"))


def q27_digit_guard(spark, d):
    """Pairs of a nation, and those whose numbers agree: counted by equal numbers, since pairs grow with the square."""
    c, s = _read(spark, d, "customer"), _read(spark, d, "supplier")
    per = lambda df, key, name, n: df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("c_nationkey"), text.digit_runs(F.col(name)).alias("runs")).agg(F.count(F.lit(1)).alias(n))
    a, b = per(c, "c_nationkey", "c_name", "n"), per(s, "s_nationkey", "s_name", "m")
    size = lambda df, n: df.groupBy("c_nationkey").agg(F.sum(n).alias(n))
    alike = a.join(b, ["c_nationkey", "runs"]).groupBy("c_nationkey").agg(F.sum(F.col("n") * F.col("m")).alias("agree"))
    met = size(a, "n").join(size(b, "m"), "c_nationkey").join(alike, "c_nationkey", "left")
    return met.select("c_nationkey", (F.col("n") * F.col("m")).alias("pairs"), F.coalesce("agree", F.lit(0)).cast("long").alias("agree"))


def q28_sort_key(spark, d):
    p = _read(spark, d, "part").withColumn("key", text.sort_key(F.upper(F.concat_ws(" ", "p_type", "p_name"))))
    return p.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def q29_ordinals(spark, d):
    """Roman and spelled numbers of one street meet in one key."""
    stems = F.create_map(*[F.lit(x) for s, n in text.ORDINALS.items() for x in (n, s.capitalize() + "ог")])
    size = F.col("p_size")
    name = F.concat(F.lit("Краља Петра "), F.when((F.col("p_partkey") % 2 == 0) & (size <= 20), stems[size]).otherwise(_roman_of(size)))
    return _read(spark, d, "part").groupBy(text.normalize_street(name).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def q30_one_edit(spark, d):
    s = _read(spark, d, "supplier").select(F.col("s_suppkey").alias("a"), F.col("s_name").alias("x"), (F.col("s_nationkey") % 3).alias("scope"))
    t = s.withColumnsRenamed({"a": "b", "x": "y"})
    near = ladder.one_edit_pairs(s, t, "scope")
    return s.join(near, ["scope", "x"]).join(t, ["scope", "y"]).where("a < b").select("a", "b")


def q31_token_subset(spark, d):
    """Parts whose name's words all occur in the name of another part of the brand."""
    p = _read(spark, d, "part").dropna(subset=["p_partkey", "p_brand", "p_name"])
    rows = p.groupBy("p_partkey", "p_brand", F.array_sort(F.array_distinct(F.split("p_name", " "))).alias("w")).agg(F.count(F.lit(1)).alias("c"))
    total = ladder.superset_counts(rows.groupBy("p_brand", "w").agg(F.sum("c").alias("c")), "p_brand")
    same = F.collect_list(F.struct("w", "c")).over(Window.partitionBy("p_partkey", "p_brand"))
    own = F.aggregate("same", F.lit(0).cast("long"), lambda s, o: s + F.when(F.size(F.array_except("w", o["w"])) == 0, o["c"]).otherwise(0))
    met = rows.withColumn("same", same).withColumn("own", own).drop("same").join(total, ["p_brand", "w"])
    return met.groupBy("p_partkey").agg(F.sum(F.col("c") * (F.col("total") - F.col("own"))).alias("n")).where("n > 0")


def q32_prefix_cluster(spark, d):
    """First words that begin the names of several parts of a brand."""
    p = _read(spark, d, "part").select("p_brand", F.element_at(F.split("p_name", " "), 1).alias("head"), "p_name").distinct()
    return p.groupBy("p_brand", "head").agg(F.count(F.lit(1)).alias("names")).where("names >= 2")


def q33_abbreviation(spark, d):
    """Names whose first word is an initial of another name with the same rest, within a brand."""
    p = _read(spark, d, "part").select("p_brand", "p_name").distinct()
    words = F.split("p_name", " ")
    short = p.select("p_brand", F.concat_ws(" ", F.left(F.get(words, F.lit(0)), F.lit(1)), F.get(words, F.lit(1))).alias("abbrev")).distinct()
    long = p.select("p_brand", F.concat_ws(" ", F.left(F.get(words, F.lit(0)), F.lit(1)), F.get(words, F.lit(1))).alias("abbrev"), "p_name")
    met = short.join(long, ["p_brand", "abbrev"]).groupBy("p_brand", "abbrev").agg(F.count_distinct("p_name").alias("n"), F.min("p_name").alias("name"))
    return met.where("n = 1").select("p_brand", "abbrev", "name")


def q34_fuzzy_top1(spark, d):
    """The most similar other nation name of the region, by the weighted ratio."""
    n = _read(spark, d, "nation")
    m = n.select("n_regionkey", F.col("n_nationkey").alias("other"), F.col("n_name").alias("name2"))
    s = n.join(m, "n_regionkey").where("n_nationkey <> other").withColumn("s", similarity.weighted_ratio_udf("n_name", "name2"))
    w = Window.partitionBy("n_nationkey").orderBy(F.col("s").desc(), "other")
    return s.withColumn("p", F.row_number().over(w)).where("p = 1").select("n_nationkey", "other", F.round("s", 2).alias("score"))


def q35_ladder(spark, d):
    """Methods by which perturbed part names resolve to a register of part names."""
    p = _read(spark, d, "part").select(F.upper("p_name").alias("name_norm"), (F.col("p_size") % 8).cast("string").alias("settlement_id"), "p_partkey", (F.col("p_size") % 2).cast("string").alias("muni_id"))
    streets = p.groupBy("name_norm", "settlement_id", "muni_id").agg(F.min("p_partkey").alias("ordinal")).withColumn("street_id", F.col("ordinal").cast("string"))
    setts = streets.select("settlement_id", "muni_id").distinct().withColumn("settlement_norm", F.concat(F.lit("ПЛАЦЕ "), "settlement_id"))
    k, words = F.col("p_partkey"), F.split("name_norm", " ")
    name = (
        F.when(k % 5 == 0, F.array_join(F.reverse(words), " ")).when(k % 5 == 1, F.concat(F.left("name_norm", F.lit(1)), F.lit(" "), F.element_at(words, -1)))
        .when(k % 5 == 2, F.concat("name_norm", F.lit("X"))).when(k % 5 == 3, F.concat(F.lit("ПЛАЦЕ "), "settlement_id")).otherwise(F.col("name_norm"))
    )
    segs = p.select(k.alias("seg_id"), "muni_id", "settlement_id", name.alias("name"), F.lit("").alias("alt"))
    return ladder.resolve(segs, streets, setts).groupBy("method").agg(F.count(F.lit(1)).alias("n"))


def q36_parse_coverage(spark, d):
    """Coverage texts written from order rows, read back by the grammar."""
    k = F.col("o_orderkey")
    clause = F.concat(F.lit("Прва "), (k % 90 + 1).cast("string"), F.lit("-"), (k % 90 + 9).cast("string"), F.lit(", Друга од "), (F.col("o_custkey") % 50 + 1).cast("string"), F.lit(" до краја, Трећа бб, Четврта"))
    rows = _read(spark, d, "orders").select("o_orderkey", F.explode(grammar.coverage_segments(clause)).alias("s"))
    iv = F.get("s.intervals", F.lit(0))
    return rows.select("o_orderkey", F.col("s.street_raw").alias("street"), iv["lo"].alias("lo"), iv["hi"].alias("hi"), iv["parity"].alias("parity"), F.col("s.whole").alias("whole"), F.col("s.bez_broja").alias("bb"))


def q37_html_rows(spark, d):
    """Data rows of tables written from customers: closing tags left out, a header row, a nested table, a missing number."""
    c = _read(spark, d, "customer")
    html = F.concat(
        F.lit("<p>x</p><table><tr><td>НАЗИВ ГЛАСАЧКОГ МЕСТА<td>a<td>b<td>c<tr><td>"), F.col("c_custkey").cast("string"), F.lit(".</td><td>"), F.col("c_name"),
        F.lit("</td><td>"), F.col("c_mktsegment"), F.lit("<br>1</td><td>"), F.col("c_nationkey").cast("string"),
        F.lit("<td>x <table><tr><td>in<td>ner</table></tr><tr><td></td><td>Дом<td>A &amp; B<td>y</td></tr><tr><td>1<td><td>z<td>w</table>"),
    )
    return html_rows(c.withColumn("html", html), "c_custkey", "html")


def q70_coverage_templates(spark, d):
    """Four ways to write coverage: slashes, word forms, labelled parts, directives in parentheses."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    n = lambda x, m: (x % m + 1).cast("string")
    clause = (
        F.when(k % 4 == 0, F.concat(F.lit("Прва "), n(k, 90), F.lit("/"), n(c, 9), F.lit(", Друга "), n(c, 50), F.lit("а")))
        .when(k % 4 == 1, F.concat(F.lit("Прва парнога, Друга непарни од "), n(k, 90), F.lit(" до "), n(c, 90)))
        .when(k % 4 == 2, F.concat(F.lit("Насеље: Брдо Улица: Прва бројеви "), n(k, 90), F.lit(", "), n(c, 50), F.lit("-200; Улица: Друга бб")))
        .otherwise(F.concat(F.lit("Прва (од броја "), n(k, 90), F.lit(" до краја парна), Трг Правде17")))
    )
    rows = _read(spark, d, "orders").select("o_orderkey", F.posexplode(grammar.coverage_segments(clause)).alias("at", "s"))
    iv, one = F.get("s.intervals", F.lit(0)), F.get("s.singles", F.lit(0))
    return rows.select(
        "o_orderkey", "at", F.col("s.settlement_raw").alias("settlement"), F.col("s.street_raw").alias("street"), F.col("s.kind").alias("kind"),
        iv["lo"].alias("lo"), iv["hi"].alias("hi"), iv["parity"].alias("parity"), one["num"].alias("num"), one["suffix"].alias("suffix"),
        F.col("s.bez_broja").alias("bb"),
    )


def q71_bullets(spark, d):
    """Amendment bullets written from orders, read back."""
    k = F.col("o_orderkey")
    n = lambda x, m: (x % m + 1).cast("string")
    text = (
        F.when(k % 4 == 0, F.concat(F.lit("назив улице „"), F.col("o_orderpriority"), F.lit("“ се исправља и  гласи: „Нова “")))
        .when(k % 4 == 1, F.concat(F.lit("у улици Прва распон кућних бројева од 1-"), n(k, 90), F.lit(" мења се и гласи \"1-"), n(k, 99), F.lit("\"")))
        .when(k % 4 == 2, F.concat(F.lit("у улици Друга после кућног броја "), n(k, 90), F.lit(" додаје се кућни број "), n(k, 90), F.lit("а.")))
        .otherwise(F.lit("остало"))
    )
    return _read(spark, d, "orders").select("o_orderkey", grammar.bullet_ops(text).alias("b")).select("o_orderkey", "b.*")


def q50_collation_rank(spark, d):
    w = Window.orderBy(F.collate("n_name", "sr_Latn"))
    return _read(spark, d, "nation").select("n_nationkey", F.row_number().over(w).alias("place"))


def q68_slugs(spark, d):
    p = _read(spark, d, "part")
    return p.select("p_partkey", text.slug(F.concat_ws(" č / ", "p_type", "p_name")).alias("slug"), text.cyr_to_lat(F.concat(F.lit("Љ "), "p_name")).alias("latin"))


def q69_escapes(spark, d):
    c = F.concat(F.col("c_name"), F.lit("'<&>"))
    return _read(spark, d, "customer").select("c_custkey", text.sql_literal(c).alias("literal"), text.xml_escape(c).alias("xml"))


QUERIES = {k: v for k, v in globals().items() if k.startswith("q") and callable(v)}

ROMAN = "(VALUES " + ", ".join(f"({n}, '{text.roman(n) if n < 40 else 'XL' + text.roman(n - 40)}')" for n in range(1, 51)) + ") AS r(n, roman)"

ORACLE_SQL = {
    "q26_normalize_key": f"""SELECT p_partkey, upper(p_name) || ' ' || replace(upper(p_brand), '#', ' ') || ' ЈНА ' || CASE WHEN n < 40 THEN n::VARCHAR ELSE roman END AS key
FROM part JOIN {ROMAN} ON n = p_size""",
    "q27_digit_guard": r"""SELECT c_nationkey, count(*) AS pairs, count(*) FILTER (regexp_extract_all(c_name, '\d+') = regexp_extract_all(s_name, '\d+')) AS agree
FROM customer JOIN supplier ON c_nationkey = s_nationkey GROUP BY 1""",
    "q28_sort_key": "SELECT array_to_string(list_sort(string_split(upper(p_type || ' ' || p_name), ' ')), ' ') AS key, count(*) AS n FROM part GROUP BY 1",
    "q29_ordinals": f"SELECT 'КРАЉА ПЕТРА ' || CASE WHEN n < 40 THEN n::VARCHAR ELSE roman END AS key, count(*) AS n FROM part JOIN {ROMAN} ON n = p_size GROUP BY 1".replace("count(*) AS n FROM", "count(*) AS n FROM"),
    "q30_one_edit": """SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey % 3 = b.s_nationkey % 3 AND a.s_suppkey < b.s_suppkey
WHERE damerau_levenshtein(a.s_name, b.s_name) <= 1""",
    "q31_token_subset": """SELECT p.p_partkey, count(*) AS n FROM part p JOIN part q ON p.p_brand = q.p_brand AND p.p_partkey <> q.p_partkey
WHERE list_has_all(string_split(q.p_name, ' '), string_split(p.p_name, ' ')) GROUP BY 1""",
    "q32_prefix_cluster": "SELECT p_brand, string_split(p_name, ' ')[1] AS head, count(DISTINCT p_name) AS names FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_name) >= 2",
    "q33_abbreviation": """SELECT p_brand, left(p_name, 1) || ' ' || string_split(p_name, ' ')[2] AS abbrev, min(p_name) AS name FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_name) = 1""",
    "q36_parse_coverage": """WITH o AS (SELECT o_orderkey, o_orderkey % 90 + 1 AS lo, o_orderkey % 90 + 9 AS hi, o_custkey % 50 + 1 AS c FROM orders)
SELECT o_orderkey, 'Прва' AS street, lo, hi, CASE WHEN lo % 2 = 1 THEN 'odd' ELSE 'even' END AS parity, false AS whole, false AS bb FROM o
UNION ALL SELECT o_orderkey, 'Друга', c, 100000, CASE WHEN c % 2 = 1 THEN 'odd' ELSE 'even' END, false, false FROM o
UNION ALL SELECT o_orderkey, 'Трећа', NULL, NULL, NULL, false, true FROM o UNION ALL SELECT o_orderkey, 'Четврта', NULL, NULL, NULL, true, false FROM o""",
    "q35_ladder": """WITH p AS (SELECT p_partkey % 5 AS c, upper(p_name) AS nm, p_size % 8 AS s FROM part), reg AS (SELECT DISTINCT nm, s FROM p),
one AS (SELECT DISTINCT nm, s, left(nm, 1) || ' ' || split_part(nm, ' ', 2) AS q FROM p WHERE c = 1),
near AS (SELECT one.q, one.s, count(DISTINCT CASE WHEN split_part(reg.nm, ' ', 1) LIKE left(q, 1) || '%' AND split_part(reg.nm, ' ', 2) = split_part(q, ' ', 2) THEN reg.nm END) AS initials,
  max(CASE WHEN length(reg.nm) >= 1.5 * length(q) THEN CASE WHEN contains(reg.nm, q) THEN 90.0 ELSE 0.0 END
    WHEN split_part(reg.nm, ' ', 2) = split_part(q, ' ', 2) THEN 200.0 * (length(q) - 1 + contains(split_part(reg.nm, ' ', 1), left(q, 1))::INT) / (length(q) + length(reg.nm)) ELSE 0.0 END) AS best
  FROM (SELECT DISTINCT q, s FROM one) one JOIN reg ON reg.s = one.s GROUP BY 1, 2),
m AS (SELECT CASE c WHEN 2 THEN 'fuzzy' WHEN 3 THEN 'settlement' WHEN 1 THEN CASE WHEN best >= 90 THEN 'fuzzy' WHEN initials = 1 THEN 'abbrev' ELSE 'none' END ELSE 'exact' END AS method
  FROM p LEFT JOIN near ON c = 1 AND near.s = p.s AND near.q = left(nm, 1) || ' ' || split_part(nm, ' ', 2))
SELECT method, count(*) AS n FROM m GROUP BY 1""",
    "q37_html_rows": """SELECT c_custkey, 0 AS pos, c_custkey::BIGINT AS number, c_name AS name, c_mktsegment || ' 1' AS address, c_nationkey || ' x inner' AS coverage FROM customer
UNION ALL SELECT c_custkey, 1, 2, 'Дом', 'A & B', 'y' FROM customer""",
    "q70_coverage_templates": """WITH o AS (SELECT o_orderkey, o_orderkey % 4 AS t, o_orderkey % 90 + 1 AS a, o_custkey % 9 + 1 AS x, o_custkey % 50 + 1 AS c, o_custkey % 90 + 1 AS e FROM orders),
r AS (SELECT o_orderkey, 0 AS at, '' AS settlement, 'Прва' AS street, 'street_numbers' AS kind, NULL::BIGINT AS lo, NULL::BIGINT AS hi, NULL AS parity, a::BIGINT AS num, x::VARCHAR AS suffix, false AS bb FROM o WHERE t = 0
UNION ALL SELECT o_orderkey, 1, '', 'Друга', 'street_numbers', NULL, NULL, NULL, c, 'А', false FROM o WHERE t = 0
UNION ALL SELECT o_orderkey, 0, '', 'Прва', 'street_numbers', 2, 100000, 'even', NULL, NULL, false FROM o WHERE t = 1
UNION ALL SELECT o_orderkey, 1, '', 'Друга', 'street_numbers', a, e, 'odd', NULL, NULL, false FROM o WHERE t = 1
UNION ALL SELECT o_orderkey, 0, 'Брдо', 'Прва', 'street_numbers', c, 200, CASE WHEN c % 2 = 0 THEN 'even' ELSE 'all' END, a, '', false FROM o WHERE t = 2
UNION ALL SELECT o_orderkey, 1, 'Брдо', 'Друга', 'whole_street', NULL, NULL, NULL, NULL, NULL, true FROM o WHERE t = 2
UNION ALL SELECT o_orderkey, 0, '', 'Прва', 'street_numbers', a, 100000, 'even', NULL, NULL, false FROM o WHERE t = 3
UNION ALL SELECT o_orderkey, 1, '', 'Трг Правде', 'street_numbers', NULL, NULL, NULL, 17, '', false FROM o WHERE t = 3) SELECT * FROM r""",
    "q71_bullets": """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'fix_street_name' WHEN 1 THEN 'replace_range' WHEN 2 THEN 'add_house' END AS op,
CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN 'Прва' WHEN 2 THEN 'Друга' END AS street,
CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN '1-' || (o_orderkey % 90 + 1) WHEN 2 THEN (o_orderkey % 90 + 1)::VARCHAR END AS old,
CASE o_orderkey % 4 WHEN 0 THEN 'Нова' WHEN 1 THEN '1-' || (o_orderkey % 99 + 1) WHEN 2 THEN (o_orderkey % 90 + 1) || 'а' END AS new FROM orders""",
    "q50_collation_rank": "SELECT n_nationkey, row_number() OVER (ORDER BY replace(n_name, '_', ' '))::INT AS place FROM nation",
    "q68_slugs": """SELECT p_partkey, trim(regexp_replace(lower(p_type) || ' c / ' || lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, 'Lj ' || p_name AS latin FROM part""",
    "q69_escapes": """SELECT c_custkey, '''' || c_name || '''''<&>''' AS literal, c_name || '&apos;&lt;&amp;&gt;' AS xml FROM customer""",
}
