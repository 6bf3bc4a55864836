"""Corpus-wide removal of repeated and nearly repeated lines by a segment-partition edit join, in DataFrame functions only.

A line within ``edits`` edits of another agrees with it on one of ``edits + 1`` segments of the shorter line, up to a
bounded shift (Li et al., "Pass-Join", 2011). Every line files its segments under its length, and looks substrings up
under each length from its own down to ``edits`` less, at the starts that the multi-match-aware bounds leave.

1. One pass over the texts writes each line's place, its 128-bit hash and its keys (hashes of length, segment number and
   substring, cut from four bytes a character); no text. Keys that only one text gives are dropped, most of all keys.
2. Lines with one of the other keys are the only ones whose text moves; each distinct text does once and gets a number.
3. Their segments and substrings are joined. A key with more than ``HOT`` segment rows is split by counts of character
   classes: ``edits`` edits change at most twice as many counts, so of one more groups of classes, the counts of one group
   are the same in both lines. Rows grow by that number, whatever the size of the key's group.
4. Pairs whose character class counts are near enough are verified by banded bit-parallel edit distance; what is kept is
   that the later line of a pair has an earlier one.

A line goes if an equal or close line comes before it in the order of (doc_id, line number). Decisions are made on the
input, so of a chain of close lines the first stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import SPACE_CHARS, discard, join_null_safe, staged, table

EDITS = 2
HOT = 16
#: Rows of one long that are broadcast at most (about 50 MB in memory); a longer list is joined by a shuffle.
MAX_BROADCAST = 1_000_000
#: Characters that are counted together; an edit changes at most two counts, by one each.
CLASSES = (*"etaonirshdlucmwgpbyfvk .", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "áàâäéèêëíîïñóôöúûüçß")


def _starts(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment from 0, shift of its start) of all substrings that a longer line looks up."""
    out = []
    for diff in range(edits + 1):
        for i in range(edits + 1):
            lo, hi = max(-i, diff - (edits - i)), min(i, diff + (edits - i))
            out += [(diff, i, shift) for shift in range(lo, hi + 1)]
    return out


def _filed(edits: int) -> list[tuple[int, int, int]]:
    """What a line files: its own segments, under its own length."""
    return [(0, i, 0) for i in range(edits + 1)]


def _keys(spec: list[tuple[int, int, int]], edits: int) -> Column:
    """Keys of a row with ``len`` and ``wide`` (the line, four bytes a character), one for each entry of spec.

    Sizes of segments differ by one at most, larger ones last. A function of one entry, called for each: written out for
    all entries, the code would outgrow what the virtual machine compiles.
    """
    n = F.lit(edits + 1)
    entries = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(x).alias("x")) for d, i, x in spec])

    def key(e: Column) -> Column:
        length = F.col("len") - e["d"]
        more = length % n
        size = ((length - more) / n).cast("int")
        extra = F.greatest(e["i"] - (n - more), F.lit(0))
        start = size * e["i"] + extra + e["x"]
        wide = size + F.when(e["i"] >= n - more, F.lit(1)).otherwise(F.lit(0))
        return F.xxhash64(length, e["i"], F.substring(F.col("wide"), start * 4 + 1, wide * 4))

    return F.transform(entries, key)


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Levenshtein distance of two character arrays, or edits + 1 if it is more; sizes may differ by edits at most.

    Myers' vertical deltas in a band of 2 * edits + 1 rows that moves down one row a column (Hyyro, 2003). Bit k of a
    column j from 1 stands for row j - edits + k. The score follows the lowest row of the band down to the last row of
    a, and from there that row to the right.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    rows, cols = F.size(a), F.size(b)
    mask = lambda x: x.bitwiseAND(F.lit(full))
    inv = lambda x: x.bitwiseXOR(F.lit(full))
    bound = lambda value, body: F.aggregate(F.array(value), F.lit(None).cast(STATE), lambda _, x: body(x))

    def column(s: Column, j: Column) -> Column:
        char = F.get(b, j - 1)
        at = lambda k: F.when(j - edits + k >= 1, F.get(a, j - edits + k - 1) == char)
        same = reduce(lambda x, k: x + F.when(at(k), F.lit(1 << k)).otherwise(F.lit(0)), range(width), F.lit(0))

        def with_same(eq: Column) -> Column:
            vp, vn = s["vp"], s["vn"]
            carry = mask((eq.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(eq).bitwiseOR(vn)

            def with_diagonal(d0: Column) -> Column:
                hp = vn.bitwiseOR(inv(d0.bitwiseOR(vp)))
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                row = rows - j + edits
                bit = lambda x, k: F.call_function("shiftright", x, k).bitwiseAND(F.lit(1))
                aside = bit(hp, row) - bit(hn, row)
                score = s["score"] + F.when(row >= width - 1, F.lit(1) - bit(d0, F.lit(width - 1))).otherwise(aside)
                return F.struct(
                    hn.bitwiseOR(inv(down.bitwiseOR(hp))).alias("vp"), down.bitwiseAND(hp).alias("vn"), score.alias("score")
                )

            return bound(carry, with_diagonal)

        return bound(same, with_same)

    start = F.struct(F.lit(full & ~((1 << edits) - 1)).alias("vp"), F.lit(0).alias("vn"), F.least(rows, F.lit(edits)).alias("score"))
    done = F.aggregate(F.sequence(F.lit(1), cols), start.cast(STATE), column, lambda s: s["score"])
    return F.when(F.abs(rows - cols) > edits, F.lit(edits + 1)).when(cols == 0, rows).otherwise(F.least(done, F.lit(edits + 1)))


STATE = "struct<vp:int,vn:int,score:int>"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tie, no, line) of every line with a word; tie is a hash of the text that tells rows of one id apart."""
    return docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.posexplode(F.split(text_col, "\n")).alias("no", "line")
    ).where(F.btrim("line", F.lit(SPACE_CHARS)) != "")


def _identity() -> list[Column]:
    """128 bits that stand for a line; the second hash starts from another seed, so that it does not follow the first."""
    return [F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2")]


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie", "no")


def _semi(rows: DataFrame, few: DataFrame, on: str, count: int) -> DataFrame:
    """Semi join that broadcasts the right side up to MAX_BROADCAST rows of one long each, and shuffles beyond."""
    return rows.join(F.broadcast(few) if count <= MAX_BROADCAST else few, on, "left_semi")


def _near_lines(lines: DataFrame, places: DataFrame, edits: int, shortest: int) -> DataFrame:
    """(n, h, h2, first, line, len, counts), one row for each text of lines that shares a key with another text.

    n is a number of its own, first its first place. A second line of one 64-bit hash would be taken for the same text when
    shared keys are sought, not after that.
    """
    given = places.where(F.col("len") >= shortest).select("h", F.explode("keys").alias("key"))
    seen = given.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    repeated = staged(seen.where(F.col("lo") < F.col("hi")).select("key"), "line-keys")
    wanted = staged(_semi(given, repeated, "key", repeated.count()).select("h").distinct(), "near-hashes")
    texts = lines.select(*_identity(), "doc_id", "tie", "no", "line")
    one = _semi(texts, wanted, "h", wanted.count()).groupBy("h", "h2").agg(F.first("line").alias("line"), F.min(_order()).alias("first"))
    one = one.withColumn("len", F.length("line")).where(F.col("len") >= shortest)
    counts = F.array(*[F.col("len") - F.length(F.translate("line", c, "")) for c in CLASSES])
    out = staged(one.withColumn("counts", counts).withColumn("n", F.monotonically_increasing_id()), "near-lines")
    discard(repeated)
    discard(wanted)
    return out


def _pairs(near: DataFrame, edits: int) -> DataFrame:
    """Candidate pairs (a, b) of numbers of texts that share a key and have character class counts within reach."""
    narrow = near.select("n", "counts", "len", F.encode("line", "UTF-32").alias("wide"))
    filed = narrow.select("n", "counts", F.explode(_keys(_filed(edits), edits)).alias("key"))
    sought = narrow.select("n", "counts", F.explode(F.array_distinct(_keys(_starts(edits), edits))).alias("key"))
    apart = F.aggregate(F.zip_with("counts", "counts2", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    filed, sought = staged(filed, "filed-keys"), staged(sought, "sought-keys")
    hot = staged(filed.groupBy("key").count().where(F.col("count") > HOT).select("key"), "hot-line-keys")
    groups = 2 * edits + 1
    of_group = lambda counts, g: F.array(*[F.get(counts, F.lit(c)) for c in range(g, len(CLASSES), groups)])
    finer = F.explode(F.array(*[F.struct(F.xxhash64("key", F.lit(g), of_group("counts", g)).alias("key"), F.lit(g).alias("g")) for g in range(groups)])).alias("x")

    def split(rows: DataFrame) -> DataFrame:
        cold, warm = rows.join(hot, "key", "left_anti"), rows.join(hot, "key", "left_semi")
        return cold.select("n", "counts", "key", F.lit(-1).alias("g")).unionByName(warm.select("n", "counts", finer).select("n", "counts", "x.*"))

    other = split(sought).withColumnsRenamed({"n": "m", "counts": "counts2", "g": "g2"})
    # Lines that agree in several groups meet in the first of them only.
    first = F.coalesce(*[F.when(of_group("counts", g) == of_group("counts2", g), g) for g in range(groups)], F.lit(groups))
    once = (F.col("g") < 0) | (F.col("g") == first)
    met = split(filed).join(other, "key").where((F.col("n") != F.col("m")) & (apart <= 2 * edits) & once)
    out = staged(met.select(F.least("n", "m").alias("a"), F.greatest("n", "m").alias("b")).distinct(), "line-pairs")
    for part in (filed, sought, hot):
        discard(part)
    return out


def close_pairs(near: DataFrame, edits: int = EDITS) -> DataFrame:
    """near(n, line, len, counts, ...) -> all pairs (a, b), a below b, of different texts within ``edits`` edits."""
    chars = near.select("n", F.filter(F.split("line", ""), lambda c: c != F.lit("")).alias("chars"))
    left, right = (chars.withColumnsRenamed({"n": x, "chars": f"chars_{x}"}) for x in "ab")
    pairs = _pairs(near, edits)
    met = pairs.join(left, "a").join(right, "b")
    out = staged(met.where(edit_distance(F.col("chars_a"), F.col("chars_b"), edits) <= edits).select("a", "b"), "close-pairs")
    discard(pairs)
    return out


def removed_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, shortest: int | None = None
) -> DataFrame:
    """(doc_id, tie, gone, n_exact, n_close) of the documents that lose lines; gone holds line numbers from 0.

    Repeats of any length go. Close lines are sought among lines of ``shortest`` characters or more: edits + 1 unless
    given, and not less, since any two lines of up to ``edits`` characters are within that many edits.
    """
    shortest = edits + 1 if shortest is None else shortest
    if shortest < edits + 1:
        raise ValueError("lines of up to edits characters are all close to each other")
    lines = _lines(docs, id_col, text_col)
    spec = sorted({*_filed(edits), *_starts(edits)})
    wide = lines.select("doc_id", "tie", "no", *_identity(), F.length("line").alias("len"), F.encode("line", "UTF-32").alias("wide"))
    places = staged(wide.withColumn("keys", _keys(spec, edits)).drop("wide"), "line-places")
    near = _near_lines(lines, places, edits, shortest)
    firsts_of = near.select(F.col("n"), "first")
    close = close_pairs(near, edits)
    links = close.join(firsts_of.withColumnsRenamed({"n": "a", "first": "first_a"}), "a")
    links = links.join(firsts_of.withColumnsRenamed({"n": "b", "first": "first_b"}), "b")
    later = links.select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("n")).distinct()
    later = near.select("n", "h", "h2").join(later, "n").select("h", "h2", F.lit(True).alias("close"))
    every = places.select("h", "h2", "doc_id", "tie", "no")
    firsts = every.groupBy("h", "h2").agg(F.min(_order()).alias("first"), F.max(_order()).alias("final"))
    struck = firsts.join(later, ["h", "h2"], "left").where((F.col("first") < F.col("final")) | F.col("close"))
    struck = staged(struck.select("h", "h2", "first", F.coalesce("close", F.lit(False)).alias("close")), "struck-lines")
    hashes = struck.select("h").distinct()
    at = _semi(every, hashes, "h", struck.count()).withColumn("here", _order()).join(struck, ["h", "h2"])
    leads = F.col("here") == F.col("first")
    gone = at.where(~leads | F.col("close")).groupBy("doc_id", "tie")
    out = staged(
        gone.agg(F.sort_array(F.collect_set("no")).alias("gone"), F.count_if(~leads).alias("n_exact"), F.count_if(leads).alias("n_close")),
        "gone-lines",
    )
    for part in (places, near, close, struck):
        discard(part)
    return out


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, shortest: int | None = None, name: str | None = "lines"
) -> DataFrame:
    """docs with the repeated and close lines cut from the text; columns and rows as before.

    n_lines, n_exact, n_close and gone are added as a struct called ``name``; an error if docs has such a column. With no
    name, nothing is added. Rows that repeat id and
    text are one document and lose the same lines. Null texts stay null, empty ones empty; null ids come last in the
    order of lines. A document may lose all its lines; its text is then empty. An empty table gives an empty result.
    """
    if name in docs.columns:
        raise ValueError(f"docs has a column {name}; give another name")
    gone = removed_lines(docs, id_col, text_col, edits, shortest)
    gone = gone.withColumnsRenamed({c: f"__{c}" for c in gone.columns})
    own = docs.withColumns({"__doc_id": F.col(id_col).cast("long"), "__tie": F.xxhash64(text_col)})
    met = join_null_safe(own, gone, ["__doc_id", "__tie"], "left")
    parts = F.split(text_col, "\n")
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    lines = F.struct(
        F.size(parts).cast("long").alias("n_lines"), F.coalesce("__n_exact", F.lit(0)).alias("n_exact"),
        F.coalesce("__n_close", F.lit(0)).alias("n_close"),
        F.coalesce("__gone", F.array().cast("array<int>")).alias("gone"),
    )
    named = met.withColumn("__lines", F.when(F.col(text_col).isNotNull(), lines))
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept)
    return named.withColumn(text_col, text).select(*docs.columns, *([F.col("__lines").alias(name)] if name else []))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    zero = lambda c: F.coalesce(F.col(f"lines.{c}"), F.lit(0)).alias(c)
    return found.select(
        "doc_id", zero("n_lines"), zero("n_exact"), zero("n_close"),
        F.coalesce(F.array_join("lines.gone", ","), F.lit("")).alias("removed_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )
