import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm.common import n_words
from cadastra.llm.mixing import fit_counts, mix_sources, mixed_documents, source_targets


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, capped, budget = {}, set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(2 * sizes[s] for s in capped)
        target = {s: 2 * sizes[s] for s in capped} | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{i}": r.choice([0, 10, 500, r.randrange(1, 100_000)]) for i in range(r.randrange(1, 25))} | {None: 77, "Ž": 9, "z": 4}
    got = {x.source: x.target for x in source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(want)
    for s in want:
        assert got[s] == pytest.approx(want[s], abs=1e-6)


@pytest.mark.parametrize("seed", range(30))
def test_fit(seed):
    r = np.random.default_rng(seed)
    size = np.unique(r.integers(0, [20, 3000, 30_000][seed % 3], r.integers(1, 400)))
    count = r.integers(1, [3, 200][seed % 2], len(size))
    budget = int(r.integers(0, int((size * count).sum()) + 1))
    k = fit_counts(size, count, budget, seed)
    assert (k >= 0).all() and (k <= count).all()
    if len(size) > 30:
        # few sizes in the tens of thousands leave few sums near a budget
        assert abs(int((k * size).sum()) - budget) <= (64 if seed % 3 == 2 else 1)


def corpus(n=600):
    r = random.Random(9)
    rows = [(i, " w\n" * r.randrange(0, 90), r.choice(["a", "a", "a", "b", "c", "d", "é", None])) for i in range(n)]
    return rows + [(n, None, "a"), (n + 1, "", None), (None, "x y z", "b"), (5, "other text", "b"), *[(n + 2, "same row", "a")] * 40]


def test_mix(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("h", F.lit(1))
    a = mix_sources(docs, n_words(F.col("text"))).collect()
    assert len(a) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(dict(sizes))
    for x in a:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source])
        assert 0 <= x.taken <= 2 * x["size"] and x.taken == x.times * x["size"]
        taken[x.source] += x.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    key = lambda x: tuple(map(str, x))
    assert sorted(a, key=key) == sorted(mix_sources(docs.repartition(7), n_words(F.col("text"))).collect(), key=key)
    out = mixed_documents(docs, n_words(F.col("text")))
    assert out.columns == docs.columns and out.count() == sum(x.times for x in a)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(docs, n_words(F.col("text"))).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], docs.schema)
    assert [x.taken for x in mix_sources(blank, n_words(F.col("text"))).collect()] == [0, 0]
