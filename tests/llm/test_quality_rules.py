import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadastra.llm import quality_rules
from cadastra.llm.quality_rules import apply_rules


def plain(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
        seen.add(x)
    n = len(w)
    return n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def corpus():
    r = random.Random(4)
    rows = []
    for i in range(300):
        t = "\n".join(" ".join(r.choice(["a", "bé", "ccc", "d#", "🙂x", "y"]) + str(r.randrange(9)) for _ in range(r.randrange(0, 30))) for _ in range(r.randrange(8)))
        if i % 5 == 0:
            t += "\n" + "\n".join(t.split("\n")[:3])
        if i % 20 == 0:
            t = "%%% ### " * 60
        rows.append((i, t, r.choice(["en", "de", None]), r.choice(["s1", None])))
    rows += [(900, None, "en", "s1"), (901, "", None, None), (902, " \n\t\n", "xx", "y"), (903, "und " * 3000, "en", "s1"), (None, "a b c a b c", "en", "s1")]
    rows += [(904, "one\x0btwo\x0cthree\rone two three", "en", "s1"), (905, "x\xa0y " * 99, "en", "s1"), rows[7], rows[7]]
    return rows


@pytest.mark.parametrize("few", [16, 0])
def test_base_measures(spark, few, monkeypatch):
    monkeypatch.setattr(quality_rules, "FEW", few)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_words", F.lit("clash"))
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in apply_rules(docs).collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t, *_ in rows), key=str)


def test_verdict(spark):
    r = random.Random(0)
    prose = lambda: " ".join(f"w{r.randrange(500)}" for _ in range(120))
    rows = [(i, prose(), "en", f"s{i % 2}") for i in range(900)]
    rows += [(1000 + i, " ".join(w + "###" for w in prose().split()), "en", "s1") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x.doc_id: x for x in apply_rules(docs).collect()}
    assert all(x.kept for i, x in got.items() if i < 1000) and not any(x.kept for i, x in got.items() if i >= 1000)
    assert not any(x.base_failed for x in got.values())


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, lang string, source string"
    assert apply_rules(spark.createDataFrame([], schema)).count() == 0
    assert [x.kept for x in apply_rules(spark.createDataFrame([(1, None, None, None)], schema)).collect()] == [False]


def test_no_python_in_the_plan(spark):
    plan = apply_rules(spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
