import json
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from cadastra.llm import packing
from cadastra.llm.packing import WordTokens, best_fit_decreasing, lower_bound, pack_documents, pieces, sequences, word_bpe

TEXTS = [
    "The naïve café's 12,000 don't\tstop\x0bnow\x85it is <|endoftext|> I'll ́x é İstanbul ΣΑΣ straße ﬁ",
    "", " \n ", "ONE", "a b  c\n\nd\r\ne", "日本語 текст 🙂🙂 a\x1cb", "key=\"ab12\" http://x.y/z?q=1 #### ***",
]


def ids_of(text):
    return Tokenizer.from_file(word_bpe()).encode(text or "", add_special_tokens=False).ids + [0]


def test_words_give_the_texts_ids(spark):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    got = WordTokens(word_bpe())(TEXTS + docs)
    for t, raw in zip(TEXTS + docs, got, strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == ids_of(t)[:-1]


def test_any_word_gives_the_tokenizers_ids():
    r = random.Random(8)
    t, tok = WordTokens(word_bpe()), Tokenizer.from_file(word_bpe())
    parts = ["a", "The", "É", "ß", "İ", "ı", "ŉ", "ª", "²", "½", "12", "'s", "'", "''", "-", "__", "<|", "|>", "<|endoftext|>", "endoftext", "\xa0", "\xad", "\t", "\x1c", "\x85", "́", "ſ", "Ǆ", "Ω", "🙂", "中", "LL", "'LL", "'RE", "×", "\u200b"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(1, 9))) for _ in range(4000)]
    for x, raw in zip(texts, t(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tok.encode(x, add_special_tokens=False).ids, repr(x)


def test_every_token_is_made_of_its_own_bytes():
    """What the merging by joined bytes rests on: alone, each token merges into itself, with and without a word's end."""
    with open(word_bpe(), encoding="utf-8") as f:
        model = json.load(f)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    inner = BPE(vocab=model["vocab"], merges=merges)
    ending = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=WordTokens.END)
    for token, i in model["vocab"].items():
        if not token.startswith("<|"):
            body = token.removesuffix(WordTokens.END)
            assert [x.id for x in (inner if body == token else ending).tokenize(body)] == [i], token


def test_no_words():
    assert WordTokens(word_bpe())(["", " ", "\n\n"]) == [b""] * 3 and WordTokens(word_bpe())(["中", "'"])[1]


def test_memory_does_not_follow_the_distinct_words():
    """Words are looked up a part at a time: about 14 bytes a character of distinct words, 73 when all were cut at once."""
    t, text = WordTokens(word_bpe()), " ".join(f"Word{i}x" for i in range(120_000))
    tracemalloc.start()
    try:
        got = t([text])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 * len(text)
    assert np.frombuffer(got[0], "<u4").tolist() == ids_of(text)[:-1]


@pytest.mark.parametrize("part", [1, 7])
def test_parts_of_the_words_give_the_same_ids(part):
    t = WordTokens(word_bpe())
    whole = t(TEXTS)
    t.WORDS = part
    assert t(TEXTS) == whole and t(["", " "]) == [b""] * 2 and t([]) == []


@pytest.mark.parametrize("seed", range(10))
def test_best_fit(seed):
    r = np.random.default_rng(seed)
    length = r.integers(1, 101, r.integers(1, 500))
    which, offset, bins = best_fit_decreasing(length, 100)
    for b in range(bins):
        at = np.sort(np.flatnonzero(which == b))
        at = at[np.argsort(offset[at])]
        assert (offset[at] == np.r_[0, np.cumsum(length[at])[:-1]]).all() and length[at].sum() <= 100
    bound = lower_bound(length, 100)
    assert -(-int(length.sum()) // 100) <= bound <= bins <= 11 * bound // 9 + 1


def test_bound_is_certain():
    assert lower_bound(np.array([60] * 5), 100) == 5
    assert lower_bound(np.array([34] * 6), 100) == 3
    assert lower_bound(np.array([100, 1]), 100) == 2
    assert lower_bound(np.array([26] * 8), 100) == 3


@pytest.mark.parametrize("group", [7, 20_000])
def test_round_trip(spark, group, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", group)
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["the", "Alpha", "x1", "é"]) for _ in range(r.randrange(0, 140)))) for i in range(200)]
    rows += [(900 + i, t) for i, t in enumerate(TEXTS)] + [(1000, None), (1001, "long text " * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("x")).withColumn("row", F.lit(0))
    found = packing.numbered(pieces(docs, word_bpe(), 64, keep_ids=True))
    packed = packing.pack_pieces(found, 64, group)
    got = packed.collect()
    by_doc, by_seq = {}, {}
    for x in got:
        by_doc.setdefault(x.doc_id, []).append(x)
        by_seq.setdefault(x.sequence_id, []).append(x)
    assert set(by_doc) == {i for i, _ in rows}
    for i, t in rows:
        ids, parts = ids_of(t), sorted(by_doc[i], key=lambda x: x.piece)
        assert [x.piece for x in parts] == list(range(-(-len(ids) // 64)))
        for x in parts:
            want = np.array(ids[x.start : x.start + x.length], "<u4")
            assert x.start == 64 * x.piece and x.length == len(want) and x.ids_crc32 == zlib.crc32(want.tobytes())
    for s in by_seq.values():
        at = 0
        for x in sorted(s, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= 64
    if group > 1000:
        assert len(by_seq) <= lower_bound(np.array([x.length for x in got]), 64) + 1
    seqs = {x.sequence_id: np.frombuffer(x.ids, "<u4").tolist() for x in sequences(packed, found).collect()}
    for x in got[:50]:
        assert seqs[x.sequence_id][x.offset : x.offset + x.length] == ids_of(dict(rows)[x.doc_id])[x.start : x.start + x.length]


def test_repeated_null_and_empty(spark):
    rows = [(1, "a b")] * 30 + [(None, None)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), word_bpe()).collect()
    assert len(got) == 31 and len({(x.sequence_id, x.offset) for x in got}) == 31 == len({x.row for x in got})
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), word_bpe()).count() == 0


def fewest(lengths, capacity):
    """The least number of sequences, by trying every placement of the longest piece that is left."""
    best = len(lengths)

    def place(rest, free):
        nonlocal best
        if len(free) >= best:
            return
        if not rest:
            best = len(free)
            return
        n, *rest = rest
        for i in {f: i for i, f in enumerate(free) if f >= n}.values():
            place(rest, [*free[:i], free[i] - n, *free[i + 1 :]])
        place(rest, [*free, capacity - n])

    place(sorted(lengths, reverse=True), [])
    return best


@pytest.mark.parametrize("seed", range(8))
def test_tiny_inputs_against_the_optimum(seed):
    r = np.random.default_rng(seed)
    length = r.integers(8, 60, 11)
    bins, least = best_fit_decreasing(length, 100)[2], fewest(length.tolist(), 100)
    assert lower_bound(length, 100) <= least <= bins <= least + 1


def test_repacking_saves_sequences_and_can_be_limited(spark):
    rows = [(i, 0, 0, n, 0, i) for i, n in enumerate([51, 26, 23] * 60 + [34, 33, 33] * 40)]
    found = packing.staged(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, row long"), "pieces")
    used = [packing.pack_pieces(found, 100, 10, rounds).select("sequence_id").distinct().count() for rounds in (0, None)]
    assert 100 <= used[1] <= used[0]
