import random

from pyspark.sql import functions as F

from cadastra.llm.quality_classifier import accepted, classify, meta_features, text_features


def test_held_out_accuracy_on_the_labelled_table(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    test = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    got = classify(docs, labels.where(~test)).join(labels.where(test), "doc_id").where("quality IS NOT NULL").toPandas()
    good = got[got.quality == 1]
    long = docs.where(F.size(F.split("text", " ")) >= 50).select("doc_id").toPandas().doc_id
    assert (got.accepted == (got.quality == 1)).mean() > 0.97
    assert good.accepted.mean() > 0.99
    assert good[good.doc_id.isin(long)].accepted.mean() > 0.995
    assert (~got[(got.quality == 0) & got.doc_id.isin(long)].accepted).mean() > 0.95


def corpus():
    r = random.Random(1)
    prose = lambda: " ".join(f"{r.choice('abcdef')}{r.randrange(300)}" for _ in range(r.randrange(30, 90)))
    rows = [(i, prose() if i % 4 else prose().upper().replace(" ", "!! "), "en", f"s{i % 3}", 100) for i in range(400)]
    return rows, [(i, int(i % 4 > 0)) for i in range(0, 400, 2)]


def test_co_training(spark):
    rows, labels = corpus()
    rows += [(900, None, None, None, None), (901, "", "en", None, -1), (None, "a b", "en", "s", 3), rows[1], (1, "other text under a known id", "x", "y", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("x"))
    lab = spark.createDataFrame([*labels, (2, None), (None, 1), (6, 0), (6, 1), (6, 1)], "doc_id long, quality int")
    got = classify(docs, lab).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got)
    assert all(x.accepted == (x.doc_id % 4 > 0) for x in got if x.doc_id is not None and 1 < x.doc_id < 900)
    assert sorted(map(str, got)) == sorted(map(str, classify(docs.repartition(3), lab).collect()))
    kept = accepted(docs, lab)
    assert kept.columns == docs.columns and kept.count() == sum(x.accepted for x in got)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [x.accepted for x in classify(docs, none).collect()] == [True]
    assert classify(docs.where("doc_id > 5"), none).count() == 0
    assert [x.score for x in classify(docs, spark.createDataFrame([(1, 0)], none.schema)).collect()] == [0.0]


def test_features():
    assert len(text_features(b"")) == len(text_features("É x\n\n y".encode())) and len(meta_features(None, None, None)) == len(meta_features("en", "s", 5))
