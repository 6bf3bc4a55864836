"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Everything is DataFrame functions. The measures of a text are computed in its own row, with array functions, so no word
leaves its document. Repeated 3-word windows are found by sorting the 64-bit hashes of the windows and looking at
neighbours. Each (language, source) group then gets a quantile sketch per measure: counts of buckets whose edges lie at
most 1/64 apart, relative to their value. Sketches merge by adding counts, so those of a language and of all rows are sums,
and the same rows give the same quantiles in any order. The quantiles of a group are drawn towards those of its language,
and these towards those of all rows, as if ``prior`` more documents had them: little in a large group, nearly all the way
in a tiny one, with no size at which the rule switches.

A document fails where a measure lies farther from its group's median than ``reach`` interquartile ranges and than what
chance allows in a text of its size: ``chance`` over the root of its number of words (or lines, for what comes by lines).

Counting is a partial aggregation, so a source that holds a third of all rows costs a few kilobytes a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import SPACE, SPACE_RE, join_null_safe, staged, table

SYMBOLS = "#*$%&|<>"
#: Each measure, the count that tells how much chance it is open to, and its scale (a mean length varies with the median).
MEASURES = {"symbol_ratio": "n_words", "dup_line_ratio": "n_lines", "repeat_ratio": "n_lines", "mean_word_chars": "n_words"}
TWO_SIDED = ("mean_word_chars",)
SCALED = {"mean_word_chars": 2.0}
REACH, CHANCE, PRIOR = 6.0, 1.0, 200
#: Binary digits kept of a value, and of those behind its point.
KEPT_BITS, POINT_BITS = 7, 20
#: Up to so many distinct repeated windows, a word is looked up among them; beyond, the windows are sorted with places.
FEW = 16


def _starts(hashes: Column, repeated: Column) -> Column:
    """Places of windows whose hash is among the repeated ones, in order."""
    few = F.transform(
        F.filter(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))),
            lambda x: F.array_contains(repeated, x["h"]),
        ),
        lambda x: x["i"],
    )
    return F.when(F.size(repeated) <= FEW, few)


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """keep columns plus word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words, n_lines; one row per input row.

    A null text counts as empty and an empty one gives zeros. n_dup_lines counts lines with a word that equal an earlier
    line; n_repeat_words counts words in 3-word windows that occur twice or more in the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        *[F.col(c) for c in keep],
        F.filter(F.split(text, SPACE_RE), lambda w: w != F.lit("")).alias("_w"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_lines"),
    )
    hashed = split.select(
        *keep, "n_symbols",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("_w") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("_w") - 3),
                lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("_h"),
    )
    done = ["n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines"]
    ordered = hashed.select(*keep, *done, "_h", F.sort_array("_h").alias("_s"))
    twice = ordered.select(
        *keep, *done, "_h",
        F.array_distinct(F.filter("_s", lambda x, i: (i > 0) & (x == F.get("_s", i - 1)))).alias("_twice"),
    )
    placed = twice.select(
        *keep, *done, "_h", _starts(F.col("_h"), F.col("_twice")).alias("_few"),
        F.when(
            F.size("_twice") > FEW, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ).alias("_p"),
    )
    same = lambda x, j: F.coalesce(F.get("_p", j)["h"] == x["h"], F.lit(False))
    many = F.sort_array(
        F.transform(
            F.filter("_p", lambda x, i: (F.when(i > 0, same(x, i - 1)).otherwise(False)) | same(x, i + 1)), lambda x: x["i"]
        )
    )
    start = placed.select(*keep, *done, F.coalesce("_few", many).alias("_at"))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + s + 3 - F.greatest(s, a["end"])).cast("long").alias("n"), (s + 3).alias("end")),
        lambda a: a["n"],
    )
    return start.select(*keep, *done, covered.alias("n_repeat_words"))


def ratios(found: DataFrame) -> DataFrame:
    per = lambda c, n: F.when(F.col(n) > 0, F.col(c) / F.col(n))
    return found.withColumns(
        {
            "symbol_ratio": per("n_symbols", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"),
            "repeat_ratio": per("n_repeat_words", "n_words"),
            "mean_word_chars": per("word_chars", "n_words"),
        }
    )


def bucket(value: Column) -> Column:
    """The lower edge of a value's bucket, in units of 2 ** -POINT_BITS: its first KEPT_BITS binary digits."""
    v = F.floor(value * F.lit(float(1 << POINT_BITS))).cast("long")
    shift = F.greatest(F.length(F.bin(v)) - KEPT_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """counts(keys, measure, bucket, n) -> (keys, measure, n, q25, q50, q75): the least bucket that so many rows reach."""
    own = [*keys, "measure"]
    summed = counts.groupBy(*own, "bucket").agg(F.sum("n").alias("n"))
    up = Window.partitionBy(*own).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = summed.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy(*own)))
    at = lambda part: F.min(F.when(F.col("upto") * 4 >= F.col("all") * part, F.col("bucket"))) / F.lit(float(1 << POINT_BITS))
    return ranked.groupBy(*own).agg(F.sum("n").alias("n"), at(1).alias("q25"), at(2).alias("q50"), at(3).alias("q75"))


def thresholds(found: DataFrame, lang_col: str = "lang", source_col: str = "source", prior: int = PRIOR) -> DataFrame:
    """found (with ratios) -> (lang, source, measure, q25, q50, q75) for each group that has a word, drawn as said above."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES])).alias("x")
    worded = found.where(F.col("n_words") > 0).select(lang_col, source_col, each).select(lang_col, source_col, "x.*")
    counts = staged(worded.groupBy(lang_col, source_col, "measure", "bucket").agg(F.count(F.lit(1)).alias("n")), "sketches")

    def drawn(lower: DataFrame, upper: DataFrame, keys: list[str]) -> DataFrame:
        named = upper.withColumnsRenamed({"n": "up_n", **{q: f"up_{q}" for q in QUARTERS}})
        met = join_null_safe(lower, named, [*keys, "measure"])
        mean = lambda q: ((F.col("n") * F.col(q) + F.lit(float(prior)) * F.col(f"up_{q}")) / (F.col("n") + F.lit(float(prior)))).alias(q)
        return met.select(*[c for c in lower.columns if c not in QUARTERS], *[mean(q) for q in QUARTERS])

    by_lang = drawn(quartiles(counts, [lang_col]), quartiles(counts, []), [])
    own = drawn(quartiles(counts, [lang_col, source_col]), by_lang.drop("n").withColumn("n", F.lit(0)), [lang_col])
    return own.select(lang_col, source_col, "measure", *QUARTERS)


QUARTERS = ("q25", "q50", "q75")


def apply_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    reach: float = REACH, chance: float = CHANCE, prior: int = PRIOR,
) -> DataFrame:
    """One row per input row: the measures, base_failed and kept.

    base_failed: under 50 words, or over half of the words in repeated 3-word windows. kept is false there, else whether
    all measures lie within the thresholds of the document's (language, source) group. Null languages and sources form
    groups of their own. Repeated rows are judged alike. An empty table gives an empty result; other columns are ignored.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text")
    )
    found = ratios(staged(measures(narrow), "measures"))
    limits = thresholds(found, prior=prior).groupBy("lang", "source").pivot("measure", list(MEASURES)).agg(*[F.first(q).alias(q) for q in QUARTERS])
    met = join_null_safe(found, limits, ["lang", "source"], "left")
    inside = F.lit(True)
    for m, units in MEASURES.items():
        middle = F.col(f"{m}_q50")
        by_chance = F.lit(chance) * (F.lit(SCALED[m]) * middle if m in SCALED else F.lit(1.0)) / F.sqrt(F.greatest(F.col(units), F.lit(1)))
        width = F.greatest(F.lit(reach) * (F.col(f"{m}_q75") - F.col(f"{m}_q25")), by_chance)
        near = F.col(m) <= middle + width
        inside &= F.coalesce(near & (F.col(m) >= middle - width) if m in TWO_SIDED else near, F.lit(True))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return met.withColumn("base_failed", failed).withColumn("kept", ~failed & inside).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "source", *MEASURES,
    )


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
