import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm.code_search import codes, search_codes, sign_codes


def plain(base, queries, k):
    out = []
    for q, c in queries:
        near = sorted((((c ^ x) % 2**64).bit_count(), i) for i, x in set(base) if i != q)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def signed(x):
    return x - 2**64 if x >> 63 else x


@pytest.mark.parametrize(("seed", "k", "shard", "block"), [(1, 5, 1 << 20, 1 << 18), (2, 1, 30, 7), (3, 10, 12, 100)])
def test_matches_brute_force(spark, seed, k, shard, block):
    r = random.Random(seed)
    centre = [r.getrandbits(64) for _ in range(15)]
    base = [(i, signed(r.choice(centre) ^ sum(1 << b for b in r.sample(range(64), r.randrange(9))))) for i in range(400)]
    base += [(1000 + i, base[0][1]) for i in range(60)] + [base[3]] * 5
    base += [(2000 + i, signed(r.getrandbits(64))) for i in range(20)]
    queries = [(i, c) for i, c in base[:460:20]] + [(2003, base[-17][1])] + [(5555, signed(centre[0]))] * 2
    asked = spark.createDataFrame(queries, "id long, code long").withColumn("distance", F.lit("x"))
    held = spark.createDataFrame(base, "id long, code long").withColumn("least", F.rand()).withColumn("block", F.lit(1))
    got = search_codes(held, asked, k, shard, block)
    assert sorted(map(tuple, got.collect())) == plain(base, queries, k)


def test_random_codes_match_brute_force(spark):
    r = np.random.default_rng(5)
    base = list(enumerate(r.integers(-(2**63), 2**63 - 1, 3000).tolist()))
    queries = base[::300]
    held = spark.createDataFrame(base, "id long, code long")
    got = search_codes(held, spark.createDataFrame(queries, "id long, code long"), 10, 1000)
    assert sorted(map(tuple, got.collect())) == plain(base, queries, 10)


def test_few_rows_and_codes(spark):
    rows = [(1, [1.0, -1.0]), (2, None), (None, [1.0]), (3, [float("nan"), 2.0]), (4, []), (5, [1.0] * 130), (4, []), (6, [None, -1.0, 1.0])]
    got = {x.id: x.code for x in codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("code", F.lit(1))).collect()}
    assert got == {1: 1, 3: 2, 4: 0, 5: -1, 6: 4}
    assert sign_codes(np.r_[np.ones(64), np.full(64, -2.0), 1.0], np.array([128, 0, 1])).tolist() == [0, 0, 1]
    base = spark.createDataFrame([(i, c) for i, c in got.items() if i < 6], "id long, code long")
    assert sorted(map(tuple, search_codes(base, base.where("id = 1"), 10).collect())) == [(1, 1, 4, 1), (1, 2, 3, 2), (1, 3, 5, 63)]
    none = base.where("id > 100")
    assert search_codes(none, base).count() == 0 and search_codes(base, none).count() == 0
    nulls = spark.createDataFrame([(None, 1), (7, None)], "id long, code long")
    got = search_codes(base.unionByName(nulls), nulls, 1).collect()
    assert [tuple(x) for x in got] == [(None, 1, 1, 0)]
