import pytest

import corpus_pipeline
from cadastra.llm.packing import CAPACITY

D = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, at, D).write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        assert at.columns == columns
        counts.append(at.count())
    good = spark.read.parquet(f"{D}/labels.parquet").where("quality = 1").count()
    assert counts[0] >= counts[1] > 0.9 * good and counts[1] == counts[2] >= counts[3]
    packed = corpus_pipeline.run(spark, D).collect()
    assert sum(r.piece == 0 for r in packed) == counts[4]
    fill = {}
    for r in packed:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= CAPACITY and sum(fill.values()) / (CAPACITY * len(fill)) > 0.95


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, lines string, tie string, times long, row string"


def odd_documents():
    rows = [(i, f"Text {i} about things. " + " ".join(f"w{i}x{j}" for j in range(40 + i)), "en", "s1", None) for i in range(30)]
    rows += [(100, None, None, None, None), (101, "", "en", "s2", 0), (102, " \n\t", "de", None, 3), (None, "no id but words", None, "s1", 5)]
    rows += [rows[3]] * 3 + [(None, "no id but words", None, "s1", 5), (None, "another text without id", "en", "s1", 5)]
    rows += [(3, "a second text of id three with words of its own", "en", "s2", 9), (200, "word " * 60_000, "en", "s2", 300_000)]
    return [(*r, "l", "t", 7, "r") for r in rows]


@pytest.mark.parametrize("rows", [odd_documents(), []])
def test_every_stage_on_odd_documents(spark, tmp_path, rows):
    (tmp_path / "tables").mkdir()
    labels = [(i, 1) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "tables/labels.parquet"))
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(str(tmp_path / "tables/documents.parquet"))
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path / "tables"))
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        got = out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert all(tuple(r[-4:]) == ("l", "t", 7, "r") for r in got)
        if name == "quality_classifier":
            assert len(got) == len(rows)
        if name == "line_dedup" and rows:
            assert len(got) == len(rows) and sum(r.text is None for r in got) == 1
        if name == "simhash_near_dedup" and rows:
            texts = [r.text for r in got]
            assert sum(r.doc_id == 3 for r in got) == 2 and sum(not (t or "").split() for t in texts) == 1
            assert sum(r.doc_id is None for r in got) == 2 and len(texts) == len(set(texts))
        if name == "mix_sources":
            kept = {(r.doc_id, r.text) for r in at.collect()}
            assert {(r.doc_id, r.text) for r in got} <= kept and len(got) <= 2 * len(kept)
        at = out
    assert bool(got) == bool(rows) and len({(r.row, r.piece) for r in got}) == len(got)
    assert corpus_pipeline.run(spark, str(tmp_path / "tables")).count() == len(got)
