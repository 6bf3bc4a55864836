import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import substring_dedup
from cadastra.llm.substring_dedup import WordHash, dedup_passages, super_kmers


def plain(rows, window):
    docs = [[w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if w] for _, t in rows]
    seen = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for (k, _), d in zip(rows, docs, strict=True):
        gone = set()
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((k, len(d), len(gone), " ".join(w for i, w in enumerate(d) if i not in gone)))
    return sorted(out, key=str)


def corpus(seed, words=400, n=60):
    r = random.Random(seed)
    vocab = [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(words)]
    passage = [[r.choice(vocab) for _ in range(r.randrange(8, 90))] for _ in range(8)]
    rows = []
    for i in range(n):
        t = []
        for _ in range(r.randrange(0, 5)):
            t += r.choice(passage) if r.random() < 0.5 else [r.choice(vocab) for _ in range(r.randrange(0, 60))]
        rows.append((i, r.choice([" ", "\n", "\t \x0b"]).join(t)))
    rows += [(900, None), (901, ""), (902, " \n "), (903, "und " * 200), (904, "a b " * 90), (905, rows[3][1]), (3, rows[3][1])]
    rows += [(906, " ".join(f"u{i}" for i in range(500))), (None, rows[5][1]), (907, "und " * 34), (908, "x\xa0y " * 40)]
    return rows


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept.decode()) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "window", "mer", "hot"), [(1, 35, 10, 4000), (2, 12, 4, 4000), (3, 12, 4, 1), (4, 5, 2, 3)])
def test_matches_brute_force(spark, seed, window, mer, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k1", F.lit("x")).withColumn("t", F.lit(1))
    assert got(dedup_passages(docs.repartition(5), window=window, mer=mer)) == plain(rows, window)


def test_many_copies_in_one_task(spark):
    rows = [(i, " ".join(f"c{j}" for j in range(80)) + f" tail{i}") for i in range(50)]
    assert got(dedup_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))) == plain(rows, 35)


@pytest.mark.parametrize("seed", range(5))
def test_super_kmers_cover_each_window_once(seed):
    r = np.random.default_rng(seed)
    words = [b"w%d" % x for x in r.integers(0, [3, 1000][seed % 2], 500)]
    start, n, mini, places = super_kmers(WordHash().array(words), 35, 10)
    assert np.concatenate([np.arange(a, a + k) for a, k in zip(start, n, strict=True)]).tolist() == list(range(466))
    by_window = {}
    for a, k, m in zip(start, n, mini, strict=True):
        for i in range(a, a + k):
            assert by_window.setdefault(tuple(words[i : i + 35]), m) == m
    assert (places >= 1).all() and n.max() <= 60


def test_empty(spark):
    assert dedup_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
