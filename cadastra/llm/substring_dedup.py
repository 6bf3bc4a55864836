"""Removal of passages that repeat anywhere in the corpus, by super-k-mer partitioning.

A window is ``window`` consecutive words of one document; a word goes if a window over it also starts anywhere else.
Each window belongs to the bucket of its minimiser, the run of ``MER`` words in it with the least hash. Consecutive
windows with one minimiser form a super-k-mer and travel as one packed string.

1. Count minimisers (hashes only, summed before the shuffle). What occurs once cannot hold a repeated window: its text
   never moves. That is most of a corpus.
2. Pack the super-k-mers of the other minimisers. A map task sends a packed string's text once, a second copy as a bare
   note and further copies not at all (they repeat, so all their windows do); no string sends more than two rows a task.
3. In each bucket, sort the windows of the packed strings and flag those that occur twice. A bucket of more than ``HOT``
   super-k-mers is dealt by whole windows instead, so no bucket in memory exceeds HOT strings of bounded length.
4. Bring the flags back to their documents and cut the words.

Documents are told apart by id and 64 bits of their text (128 bits where the id is null); repeated rows need no number of their own: each counts as a document, and all get the same flags. Texts are shuffled compressed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import spread, staged, table, text_bytes

WINDOW = 35
MER = 10
HOT = 4000
#: Windows of a super-k-mer at most: its flags are the bits of a long.
RUN = 60
MEMO = 300_000


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word, 1)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def super_kmers(h: np.ndarray, window: int, mer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, minimiser, places) of the super-k-mers of a document's word hashes.

    places counts the positions of the minimiser that its windows chose (the leftmost in each). Equal windows choose
    different positions at equal distance, so windows that repeat within one super-k-mer make places exceed 1.
    """
    if len(h) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    n = len(h) - mer + 1
    value = np.zeros(n, np.uint64)
    for j in range(mer):
        value *= np.uint64(0x9E3779B97F4A7C15)
        value += h[j : j + n]
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    least = (value & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    width, span = window - mer + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    minimiser = value[place].view(np.int64)
    change = np.flatnonzero(np.r_[True, minimiser[1:] != minimiser[:-1]])
    length = np.diff(np.r_[change, len(minimiser)])
    if length.max() > RUN:
        change = np.concatenate([np.arange(a, a + k, RUN) for a, k in zip(change, length, strict=True)])
        length = np.diff(np.r_[change, len(minimiser)])
    moved = np.r_[0, np.cumsum(place[1:] != place[:-1])]
    places = moved[change + length - 1] - moved[change] + 1
    return change, length, minimiser[change], places


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list:
    """The id (a hash of the text where it is null, ids next to each other pack well) and 64 more bits of the text."""
    text = F.col(text_col)
    return [F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.lit(1), text)).alias("k1"), F.xxhash64(text).alias("k2")]


def _batch(names: list[str], rows: list[tuple], kinds: list) -> pa.RecordBatch:
    cols = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)


def _raw(x: pa.Scalar) -> bytes:
    return x.as_buffer().to_pybytes()


def _minimisers(keyed: DataFrame, window: int, mer: int) -> DataFrame:
    """keyed(k1, k2, t) -> (mini, k1, k2, ord, places): one narrow row per super-k-mer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for b in batches:
            k1, k2, parts = b.column(0).to_numpy(), b.column(1).to_numpy(), []
            for i, t in enumerate(b.column(2)):
                _, _, mini, places = super_kmers(memo.array(_raw(t).split()), window, mer)
                if len(mini):
                    n = len(mini)
                    parts.append((mini, np.full(n, k1[i]), np.full(n, k2[i]), np.arange(n, dtype=np.int32), places.astype(np.int32)))
            if parts:
                cols = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=["mini", "k1", "k2", "ord", "places"])

    return keyed.mapInArrow(run, "mini long, k1 long, k2 long, ord int, places int")


def _blobs(keyed: DataFrame) -> DataFrame:
    """keyed(k1, k2, t, ...) with t compressed, for shuffles of whole texts."""
    schema = keyed.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            at = b.schema.get_field_index("t")
            yield b.set_column(at, "t", pa.array([press.compress(_raw(t)) for t in b.column(at)], pa.binary()))

    return keyed.mapInArrow(run, schema)


TRAVEL = "key long, pk binary, packed binary, k1 long, k2 long, start int, n int, done boolean"
TRAVEL_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]


def _packed(listed: DataFrame, window: int, mer: int) -> DataFrame:
    """listed(k1, k2, t, picks) -> packed super-k-mers on their way to a bucket, or done where a task has met two before.

    picks holds 2 * ord, plus 1 where the minimiser is hot; a hot one's windows travel one by one under their own hash.
    """
    names = [f.split()[0] for f in TRAVEL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, met, unpress, rows = WordHash(), {}, zstandard.ZstdDecompressor(), []
        for b in batches:
            for k1, k2, t, picks in zip(*[b.column(i) for i in range(4)], strict=True):
                k1, k2 = k1.as_py(), k2.as_py()
                words = unpress.decompress(_raw(t)).split()
                start, length, mini, _ = super_kmers(memo.array(words), window, mer)
                joined = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                begins = np.r_[0, ends[:-1] + 1]
                for pick in picks.as_py():
                    i = pick >> 1
                    s, n, key = int(start[i]), int(length[i]), int(mini[i])
                    for at, k in [(s + j, 1) for j in range(n)] if pick & 1 else [(s, n)]:
                        text = joined[begins[at] : ends[at + k + window - 2]]
                        pk = xxhash.xxh3_128_digest(text)
                        seen = met.get(pk, 0)
                        if seen < 2:
                            met[pk] = seen + 1
                        if pick & 1:
                            key = int.from_bytes(pk[:8], "little", signed=True)
                        rows.append((key, pk, None if seen else text, k1, k2, at, k, seen >= 2))
                if len(met) > MEMO:
                    met.clear()
                if len(rows) > 5000:
                    yield _batch(names, rows, TRAVEL_TYPES)
                    rows = []
        if rows:
            yield _batch(names, rows, TRAVEL_TYPES)

    return listed.mapInArrow(run, TRAVEL)


def _flag_bucket(rows: list[tuple], window: int) -> Iterator[tuple[int, int, int, int]]:
    """rows(pk, packed or None, k1, k2, start, n) of one bucket -> (k1, k2, start, flags) of rows with repeated windows."""
    times: dict[bytes, int] = {}
    text: dict[bytes, bytes] = {}
    for pk, packed, *_ in rows:
        times[pk] = times.get(pk, 0) + 1
        if packed is not None:
            text[pk] = packed
    flags: dict[bytes, int] = dict.fromkeys(times, 0)
    if len(times) == 1 and len(rows) > 1:
        flags = {rows[0][0]: (1 << RUN) - 1}
    else:
        windows = []
        for pk, packed in text.items():
            ends = [i for i, c in enumerate(packed) if c == 32] + [len(packed)]
            begins = [0] + [e + 1 for e in ends[:-1]]
            windows += [(packed[begins[i] : ends[i + window - 1]], pk, i) for i in range(len(ends) - window + 1)]
        windows.sort()
        for _, same in groupby(windows, key=lambda x: x[0]):
            same = list(same)
            if len(same) > 1 or times[same[0][1]] > 1:
                for _, pk, i in same:
                    flags[pk] |= 1 << i
    for pk, _, k1, k2, start, n in rows:
        if f := flags[pk] & ((1 << n) - 1):
            yield k1, k2, start, f


def _flags(travel: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["k1", "k2", "start", "flags"], [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        key, held, out = None, [], []
        for b in batches:
            for row in zip(*[b.column(i).to_pylist() for i in range(7)], strict=True):
                if row[0] != key:
                    out += _flag_bucket(held, window)
                    key, held = row[0], []
                    if len(out) > 10_000:
                        yield _batch(names, out, kinds)
                        out = []
                held.append(row[1:])
        out += _flag_bucket(held, window)
        if out:
            yield _batch(names, out, kinds)

    narrow = travel.select("key", "pk", "packed", "k1", "k2", "start", "n")
    dealt = narrow.repartition(spread(travel.sparkSession), "key").sortWithinPartitions("key", "pk")
    return dealt.mapInArrow(run, "k1 long, k2 long, start int, flags long")


def _cut(n: int, start: np.ndarray, flags: np.ndarray, window: int) -> np.ndarray:
    """Which of n words lie in a flagged window."""
    hit = np.zeros(n + 1, np.int32)
    for bit in range(RUN):
        at = start[(flags >> bit) & 1 == 1] + bit
        np.add.at(hit, at, 1)
        np.add.at(hit, at + window, -1)
    return np.cumsum(hit[:n]) > 0


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, mer: int = MER) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept is the remaining words, joined by one space, as UTF-8 bytes.

    One row per input row. All windows are judged on the input: every copy of a repeated passage goes, the first
    included. Null texts count as empty, texts under ``window`` words keep all words, rows that are repeated count as
    documents of their own. An empty table gives an empty result; other columns are ignored.
    """
    keyed = docs.select(*_keys(docs, id_col, text_col), text_bytes(text_col).alias("t"))
    found = _minimisers(keyed, window, mer)
    often = (
        found.groupBy("mini").agg(F.sum("places").alias("places"), F.count(F.lit(1)).alias("n"))
        .where(F.col("places") > 1).select("mini", (F.col("n") > HOT).cast("int").alias("hot"))
    )
    picks = found.join(often, "mini").groupBy("k1", "k2").agg(F.collect_set(F.col("ord") * 2 + F.col("hot")).alias("picks"))
    listed = _blobs(keyed).join(picks, ["k1", "k2"]).select("k1", "k2", "t", "picks")
    moving = staged(_packed(listed, window, mer), "super-k-mers")
    met = moving.where("done").select("k1", "k2", "start", F.expr("shiftleft(1L, n) - 1L").alias("flags"))
    flags = met.unionByName(_flags(moving.where("NOT done"), window))
    per_doc = flags.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "flags")).alias("flags"))
    whole = docs.select(*_keys(docs, id_col, text_col), F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t"))
    joined = _blobs(whole).join(per_doc, ["k1", "k2"], "left").select("doc_id", "t", "flags")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        names, kinds = ["doc_id", "n_words", "n_removed", "kept"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            rows, held = [], 0
            for i, t, f in zip(*[b.column(i) for i in range(3)], strict=True):
                words = unpress.decompress(_raw(t)).split()
                n = kept = len(words)
                if f.is_valid and len(f):
                    start, flag = f.values.flatten()
                    gone = _cut(n, start.to_numpy().astype(np.int64), flag.to_numpy(), window)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    kept = len(words)
                rows.append((i.as_py(), n, n - kept, b" ".join(words)))
                held += len(rows[-1][3])
                if held > 1 << 23:
                    yield _batch(names, rows, kinds)
                    rows, held = [], 0
            if rows:
                yield _batch(names, rows, kinds)

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
