"""Mixing sources to target weights by subset-sum budget fitting on exact length counts.

Each source's budget is split into whole passes over the source and a rest. The rest is fitted on the source's length
histogram alone: most of it in proportion to the counts, what then remains by a bounded-knapsack dynamic program over the
lengths that are left. Only then are documents chosen: of each (source, length) as many as the fit says, in the order of
a seeded hash. The ranks come from 256 hash slices whose counts are added up first, so a length that a third of all
documents share is never sorted in one task. Text is read once; everything after moves four narrow columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import join_null_safe, n_words, staged, table

WEIGHTS = (5.0, 2.0, 1.0)
SLICES = 256
#: Largest remaining budget that the dynamic program fits; above it, counts are filled in seeded order first.
DP_BUDGET = 1 << 16


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """sizes(source, source_size) -> plus target: weights repeat over the sources in code point order, null last.

    The targets add up to share times all sizes (as far as the caps allow); none exceeds repeats times its source's
    size, and what a cap cuts off is shared by weight among the others. In the order of cap over weight the capped
    sources come first, so one pass finds the common level of the rest.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = sizes.withColumn(
        "w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(0))
    leveled = (
        placed.withColumn("ratio", F.col("cap") / F.col("w"))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0)))
        .withColumn("budget", F.sum("source_size").over(all_rows) * F.lit(float(share)))
        .withColumn("w_left", F.sum("w").over(all_rows) - F.col("w_before"))
        .withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("w_left"))
        .withColumn("first_free", F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "level"))).over(all_rows))
    )
    free = F.col("first_free.level") * F.col("w")
    target = F.when(F.col("first_free").isNull() | (F.col("ratio") < F.col("first_free.ratio")), F.col("cap"))
    return leveled.select("source", "source_size", target.otherwise(F.least("cap", free)).alias("target"))


def fit_counts(size: np.ndarray, count: np.ndarray, budget: int, seed: int, dp_budget: int = DP_BUDGET) -> np.ndarray:
    """How many documents of each size to take so that sizes times counts come as near budget as can be.

    What is left after counts in proportion goes to the dynamic program; over dp_budget of it, whole documents in seeded
    order come first, down to an amount that the program then fits.
    """
    total = int((size * count).sum())
    if budget <= 0 or total <= 0:
        return np.zeros(len(size), np.int64)
    if budget >= total:
        return count.copy()
    take = np.array([int(c) * budget // total for c in count.tolist()], np.int64)
    left = budget - int((take * size).sum())
    order = np.random.default_rng(seed).permutation(np.flatnonzero(size > 0))
    spare = count - take
    usable = size[(size > 0) & (spare > 0)]
    limit = max(dp_budget, 2 * int(usable.min())) if len(usable) else 0
    for i in order:
        if left <= limit:
            break
        more = min(int(spare[i]), max(0, (left - limit // 2) // int(size[i])))
        take[i] += more
        left -= more * int(size[i])
    return take + _knapsack(size, count - take, left, order)


def _knapsack(size: np.ndarray, spare: np.ndarray, budget: int, order: np.ndarray) -> np.ndarray:
    """Bounded subset sum by a bit set of reachable sums; the largest sum up to budget, or one overshoot if nearer."""
    extra = np.zeros(len(size), np.int64)
    mask, reach, steps = (1 << (budget + 1)) - 1, 1, []
    for i in order.tolist():
        s, c, part = int(size[i]), min(int(spare[i]), budget // int(size[i])), 1
        while c > 0 and not reach >> budget & 1:
            n = min(part, c)
            steps.append((i, n, reach))
            reach |= (reach << (n * s)) & mask
            c, part = c - n, part * 2
        if reach >> budget & 1:
            break
    at = reach.bit_length() - 1
    gap = budget - at
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            extra[i] += n
            at -= n * int(size[i])
    over = [i for i in order.tolist() if spare[i] > extra[i] and size[i] < 2 * gap]
    if over:
        extra[min(over, key=lambda i: abs(int(size[i]) - gap))] += 1
    return extra


def _fit(pdf: pd.DataFrame, seed: int, dp_budget: int) -> pd.DataFrame:
    total, target = int(pdf.source_size.iloc[0]), float(pdf.target.iloc[0])
    passes = int(target // total) if total else 0
    rest = int(round(target - passes * total))
    k = fit_counts(pdf["size"].to_numpy(np.int64), pdf["count"].to_numpy(np.int64), rest, seed, dp_budget)
    return pd.DataFrame({"source": pdf.source, "size": pdf["size"], "passes": passes, "chosen": k, "source_size": total, "target": target})


def mix_sources(
    docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: tuple = WEIGHTS, share: float = 1.5, repeats: float = 2.0, seed: int = 7, dp_budget: int = DP_BUDGET, slices_of: int = SLICES,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, times, taken, tie): times is how often the mix takes the document.

    One row per input row. A null source is a source of its own, a null size counts as 0, and documents of size 0 are
    taken as often as their source's whole passes say. Equal rows share a seeded hash, so which of them is chosen makes
    no difference and reruns agree. An empty table gives an empty result; other columns are ignored. ``tie`` is a hash
    of the text that tells rows of one doc_id apart. Ranks within a length come from ``slices_of`` hash slices; targets are
    one row a source and are worked out in one task.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"), F.xxhash64(F.col(text_col)).alias("tie"),
    )
    rows = staged(narrow.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "tie")), "mix-rows")
    rows = rows.withColumn("slice", F.pmod("h", F.lit(slices_of)))
    slices = rows.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n"))
    lengths = staged(slices.groupBy("source", "size").agg(F.sum("n").alias("count")), "mix-lengths")
    targets = source_targets(
        lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("count")).alias("source_size")), weights, share, repeats
    )
    fitted = (
        join_null_safe(lengths, targets, ["source"])
        .groupBy("source")
        .applyInPandas(
            lambda pdf: _fit(pdf.sort_values("size", ignore_index=True), seed, dp_budget),
            "source string, size long, passes long, chosen long, source_size long, target double",
        )
    )
    per_length = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.withColumn("before", F.coalesce(F.sum("n").over(per_length), F.lit(0)))
    plan = staged(join_null_safe(before.drop("n"), fitted, ["source", "size"]), "mix-plan")
    rank = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("h", "doc_id"))
    joined = join_null_safe(rows.withColumn("rank", rank), plan, ["source", "size", "slice"])
    times = F.col("passes") + (F.col("rank") + F.col("before") <= F.col("chosen")).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"), "tie"
    )


def mixed_documents(docs: DataFrame, size: Column, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """The documents of the mix with the columns of docs, each as often as the mix takes it.

    Rows equal in id and text share what they are taken in all; null ids, texts and sources are values like others. An
    empty table gives an empty result.
    """
    mix = mix_sources(docs, size, id_col, text_col=text_col, **kwargs)
    per_row = mix.groupBy("doc_id", "tie").agg(F.sum("times").alias("__times"), F.count(F.lit(1)).alias("__rows"))
    per_row = per_row.withColumnsRenamed({"doc_id": "__id", "tie": "__tie"})
    own = docs.withColumn("__tie2", F.xxhash64(F.col(text_col)))
    met = own.join(per_row, own[id_col].eqNullSafe(F.col("__id")) & (F.col("__tie2") == F.col("__tie")))
    # Equal rows share what they are taken in all; the first of them in any order gets what does not divide evenly.
    once = met.where(F.col("__rows") == 1)
    again = met.where(F.col("__rows") > 1).withColumn(
        "__n", F.row_number().over(Window.partitionBy("__id", "__tie").orderBy(F.lit(0)))
    )
    again = again.withColumn(
        "__times",
        F.floor(F.col("__times") / F.col("__rows"))
        + (F.col("__n") <= F.col("__times") % F.col("__rows")).cast("long"),
    ).drop("__n")
    out = once.unionByName(again).where(F.col("__times") > 0)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*docs.columns)


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix_sources(docs, n_words(F.col("text"))).select("doc_id", "size", "source_size", "target", "taken")
