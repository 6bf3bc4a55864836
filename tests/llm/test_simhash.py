import random

import xxhash
from pyspark.sql import functions as F

from cadastra.llm import simhash
from cadastra.llm.simhash import fingerprint_of, near_duplicate_groups


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(fps):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, f, least.get(find(k))) for k, (i, f) in enumerate(fps)), key=str)


def corpus(seed=3):
    r = random.Random(seed)
    rows = [(0, ""), (1, None), (2, " \t\n"), (3, "One"), (4, "one two"), (5, "ONE two"), (6, "École ÉCOLE é\x0b x y"), (None, "null id")]
    base = [" ".join(r.choice("the of and to be an in".split()) + str(r.randrange(30)) for _ in range(r.randrange(3, 400))) for _ in range(30)]
    for i, t in enumerate(base):
        rows.append((100 + i, t))
        for j in range(r.randrange(4)):
            w = t.split()
            for _ in range(r.randrange(3)):
                w[r.randrange(len(w))] = "new"
            rows.append((1000 + 10 * i + j, " ".join(w)))
    rows.append(rows[10])
    return rows


def got(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=str)


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))
    assert got(near_duplicate_groups(docs)) == plain_components(rows)


def test_hot_buckets_go_a_second_way(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 1)
    rows = corpus(5)
    assert got(near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == plain_components(rows)


def test_links_within_random_bits(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = {b for b in base} | {b ^ sum(1 << x for x in r.sample(range(64), r.randrange(1, 6))) for b in base for _ in range(60)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    from cadastra.llm.components import connected_components

    found = {x.node % 2**64: x.root for x in connected_components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()}
    todo, comp = set(fps), {}
    while todo:
        queue = [todo.pop()]
        group = list(queue)
        while queue:
            a = queue.pop()
            near = [b for b in todo if (a ^ b).bit_count() <= 3]
            todo -= set(near)
            queue += near
            group += near
        for g in group:
            comp[g] = frozenset(group)
    for f in fps:
        assert (f in found) == (len(comp[f]) > 1)
    roots = {}
    for f in found:
        roots.setdefault(found[f], set()).add(f)
    assert {frozenset(x) for x in roots.values()} == {x for x in comp.values() if len(x) > 1}


def test_very_long_and_empty(spark):
    long = "word other third " * 60_000
    assert fingerprint_of(long.encode()) == plain_fingerprint(long)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicate_groups(none).count() == 0
