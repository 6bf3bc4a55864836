import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cadastra.llm import line_dedup
from cadastra.llm.line_dedup import CLASSES, close_pairs, dedup_lines, edit_distance, removed_lines

MIN_CLOSE = 3


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(r, s, k):
    for _ in range(k):
        i = r.randrange(len(s) + 1)
        s = r.choice([s[:i] + "x" + s[i:], s[:i] + s[i + 1 :], s[:i] + "é" + s[i + 1 :]])
    return s


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    r = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("abé") for _ in range(r.randrange(0, 24)))
        pairs.append((a, edited(r, a, r.randrange(edits + 3)) if r.random() < 0.8 else "".join(r.choice("ab") for _ in range(r.randrange(24)))))
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != F.lit(""))
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", edit_distance(chars("a"), chars("b"), edits).alias("d"))
    for x in got.collect():
        assert x.d == min(distance(x.a, x.b), edits + 1), x


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdetozé") for _ in range(r.randrange(1, 8)))
    base = [" ".join(word() for _ in range(r.randrange(1, 18))) for _ in range(60)]
    rows = []
    for i in range(120):
        lines = [edited(r, r.choice(base), r.choice([0, 0, 1, 2, 3, 4])) for _ in range(r.randrange(0, 6))]
        rows.append((i, "\n".join(lines)))
    rows += [(900, None), (901, ""), (902, "\n\n"), (None, rows[3][1]), rows[5], (903, "long line " * 9000), (904, "long line " * 8999 + "long lime "), (4, "a second text of id four")]
    return rows


def plain(rows, edits):
    """(kept text or None) of each row: rows of one id and text are one document; an earlier equal or close line wins."""
    order = sorted({(i is None, i, t) for i, t in rows if t is not None}, key=lambda x: (x[0], x[1] or 0))
    seen, gone = [], {}
    for _, i, t in order:
        for no, line in enumerate(t.split("\n")):
            near = any(line == s or (len(line) >= MIN_CLOSE and len(s) >= MIN_CLOSE and abs(len(s) - len(line)) <= edits and len(s) < 500 and distance(s, line) <= edits) or (len(s) > 500 and len(line) > 500) for s in seen)
            if line.strip(" \t\n\v\f\r"):
                if near:
                    gone.setdefault((i, t), set()).add(no)
                seen.append(line)
    return sorted(((i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get((i, t), ()))) for i, t in rows), key=str)


@pytest.mark.parametrize(("seed", "hot", "most"), [(1, 16, 1_000_000), (2, 0, 10)])
def test_matches_brute_force(spark, seed, hot, most, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST", most)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit("x")).withColumn("gone", F.lit(2))
    out = dedup_lines(docs.repartition(3))
    assert out.columns == [*docs.columns, "lines"]
    got = out.collect()
    # ids shared by two texts have no order between them in the brute-force version
    assert sorted(((r.doc_id, r.text) for r in got if r.doc_id != 4), key=str) == [x for x in plain(rows, 2) if x[0] != 4]
    assert any(r.lines and r.lines.n_close for r in got) and any(r.lines and r.lines.n_exact for r in got)


@pytest.mark.parametrize("hot", [16, 1])
def test_all_links(spark, hot, monkeypatch):
    r = random.Random(7)
    base = ["".join(r.choice("abcde ") for _ in range(r.randrange(24, 40))) for _ in range(12)]
    lines = sorted({e for b in base for _ in range(25) if len(e := edited(r, b, r.randrange(4))) >= MIN_CLOSE})
    df = spark.createDataFrame(list(enumerate(lines)), "n long, line string").withColumn("len", F.length("line"))
    near = df.withColumn("counts", F.array(*[F.col("len") - F.length(F.translate("line", c, "")) for c in CLASSES]))
    monkeypatch.setattr(line_dedup, "HOT", hot)
    got = {(lines[x.a], lines[x.b]) for x in close_pairs(near).collect()}
    assert got == {(a, b) for i, a in enumerate(lines) for b in lines[i + 1 :] if distance(a, b) <= 2}


def test_clash_and_bounds(spark):
    docs = spark.createDataFrame([(1, "one line here\none line herr", 5)], "doc_id long, text string, lines int")
    with pytest.raises(ValueError):
        dedup_lines(docs)
    with pytest.raises(ValueError):
        removed_lines(docs, shortest=2)
    got = dedup_lines(docs, name=None)
    assert got.columns == docs.columns and got.first() == (1, "one line here", 5)
    assert dedup_lines(docs, name="found", shortest=30).first()["text"] == docs.first()["text"]


def test_empty_and_no_python(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    out = dedup_lines(none)
    assert out.count() == 0 and not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
