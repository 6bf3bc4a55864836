import os
import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from cadastra.llm import near_copies
from cadastra.llm.near_copies import keep_one_copy, near_copy_groups, similar_groups


def plain_sets(texts):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def plain_components(rows):
    sets, root = plain_sets([t for _, t in rows]), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if similar(sets[a], sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def corpus(seed):
    r = random.Random(seed)
    rows = [(0, ""), (1, None), (2, " \t\n"), (3, "One"), (4, "one two"), (5, "ONE two"), (None, "null id"), (None, "null id")]
    for i in range(60):
        w = [f"w{r.randrange(900)}" for _ in range(r.randrange(3, 400))]
        rows.append((100 + i, " ".join(w)))
        for j in range(4):
            c = list(w)
            for _ in range(r.randrange(1, 2 + len(w) // 30)):
                c[r.randrange(len(c))] = "new"
            rows.append((1000 + 10 * i + j, " ".join(c)))
    rows.append(rows[10])
    return rows


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sid", F.lit("x"))
        assert sorted(((r.doc_id, r.component_id) for r in near_copy_groups(docs).collect()), key=str) == plain_components(rows)


def test_stage_drops_copies_that_lie_many_bits_apart(spark):
    """Pairs at 0.8 to 0.9 differ in about five to ten bits, so a distance of three leaves most of them."""
    r = random.Random(4)
    rows = []
    for i in range(60):
        w = [f"w{r.randrange(5000)}" for _ in range(200)]
        rows.append((i, " ".join(w)))
        for at in (20, 90, 150):
            w[at] = "new"
        rows.append((1000 + i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == list(range(60))


def test_groups_of_many_sets():
    r = np.random.default_rng(3)
    base = [r.choice(2000, 60, replace=False) for _ in range(15)]
    sets = [np.unique(np.r_[b[k:], r.choice(2000, 3)]).astype("<u8") for b in base for k in range(12)]
    got = similar_groups(sets, 0.8).tolist()
    plain = [set(x.tolist()) for x in sets]
    todo, want = set(range(len(sets))), [0] * len(sets)
    while todo:
        queue = [todo.pop()]
        name = min(queue)
        for a in queue:
            near = [b for b in todo if similar(plain[a], plain[b])]
            todo -= set(near)
            queue += near
        name = min(queue)
        for a in queue:
            want[a] = name
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want)) > 1


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_copy_groups(none).count() == 0


def test_texts_are_dealt_once_and_sets_deleted(spark, monkeypatch):
    """Disk: the sets are larger than the texts and not read any more; joins and duplicates go by the same keys."""
    written, stage = {}, near_copies.staged
    monkeypatch.setattr(near_copies, "staged", lambda df, name: written.setdefault(name, stage(df, name)))
    rows = [*corpus(3), (3, "another one"), (None, "a second null id"), (0, "zero is an id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_one_copy(docs)
        plan = kept._jdf.queryExecution().executedPlan().initialPlan()
        got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not os.path.exists(written["near-sets"]._staged_path.removeprefix("file://"))

    moves = 0
    while plan.children().size():  # the texts come from the left
        moves += plan.nodeName() == "Exchange"
        plan = plan.children().apply(0)
    assert moves == 1
    least = {c for _, c in plain_components(rows)}
    assert {(None, "a second null id"), (None, "null id"), (0, "zero is an id"), (0, "")} <= set(got) and len(got) == len(set(got))
    assert {i for i, _ in got} == least
