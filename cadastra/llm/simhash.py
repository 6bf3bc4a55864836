"""SimHash near-duplicate groups: 64-bit fingerprints linked at a small Hamming distance, by pigeonhole blocks.

The fingerprint is cut into ``2 * distance`` blocks (four for distance 1 and 2, six for distance 3). Two fingerprints
within ``distance`` bits agree on at least half of them, so each fingerprint is filed under every choice of that many
blocks (20 choices of about 32 bits for distance 3) and compared only with those filed under the same key. About 32 key
bits keep the buckets near constant up to billions of distinct fingerprints. A bucket with more than ``BUCKET``
fingerprints is filed once more under choices of blocks of its other bits; what then shares a key agrees on about 48 of
64 bits, so such a bucket holds at most 2**17 fingerprints, a bound that does not grow with the data.

Copies never meet each other: equal fingerprints are one row before any key is made, and a bucket returns the edges of a
spanning forest of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import spread, staged, text_bytes
from cadastra.llm.components import connected_components

SEED = 42
BUCKET = 2048
#: Rows of shingle hashes that are turned into bits at once.
CHUNK = 1 << 15


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of words of a UTF-8 text with A-Z lower-cased, in order and with repeats."""
    words = text.lower().split()
    n = len(words)
    joined = b" ".join(words)
    if n <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if n else [], dtype="<u8")
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: n - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], dtype="<u8")


def _fingerprint(raw: np.ndarray) -> int:
    total = np.zeros(64, np.int64)
    for at in range(0, len(raw), CHUNK):
        bits = np.unpackbits(raw[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(raw), bitorder="little").view("<u8")[0])


def fingerprint_of(text: bytes, shingle: int = 3) -> int:
    """Fingerprint (unsigned) of a UTF-8 text: A-Z lower-cased, shingles of words with repeats, XXH64 with seed 42."""
    return _fingerprint(shingle_hashes(text, shingle))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp), one row per input row; fp holds the unsigned fingerprint's bits in a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint_of(x.as_buffer().to_pybytes(), shingle)) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("t"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def _masks(bits: list[int], blocks: int, keep: int) -> list[int]:
    """All masks (signed) that hold ``keep`` of ``blocks`` near-equal runs of the given bit positions."""
    runs = [[int(b) for b in x] for x in np.array_split(np.array(bits), blocks)]
    return [_signed(sum(1 << b for r in choice for b in r)) for choice in combinations(runs, keep)]


def _layout(distance: int) -> tuple[int, int]:
    blocks = max(2 * distance, distance + 2)
    return blocks, blocks - distance


def _bucket_edges(key: np.ndarray, fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal keys; small runs by shifted comparison, larger ones as a spanning forest."""
    out = []
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[start, len(key)])
    run = np.repeat(np.arange(len(start)), size)
    small = size <= 32
    in_small = small[run]
    k, f = run[in_small], fp[in_small]
    for lag in range(1, int(size[small].max(initial=1))):
        hit = (k[lag:] == k[:-lag]) & (np.bitwise_count(f[lag:] ^ f[:-lag]) <= distance)
        if hit.any():
            out.append((f[lag:][hit], f[:-lag][hit]))
    for i in np.flatnonzero(~small):
        out.append(_forest(fp[start[i] : start[i] + size[i]], distance))
    return out


def _forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first spanning forest of the links of one bucket: each fingerprint is compared with the unreached ones."""
    left, a, b = fp, [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= distance
            if near.any():
                found = left[near]
                a.append(found)
                b.append(np.full(len(found), at))
                queue.extend(found)
                left = left[~near]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _edges(keyed: DataFrame, distance: int) -> DataFrame:
    """keyed(key, fp) -> (u, v): links of fingerprints that share a key; a bucket is one run of a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a, b in _bucket_edges(k, f, distance) if len(k) else []:
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["u", "v"])

        for batch in batches:
            k = np.concatenate([rest_k, batch.column(0).to_numpy()])
            f = np.concatenate([rest_f, batch.column(1).to_numpy().view(np.uint64)])
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))  # the last run may go on in the next batch
            yield from links(k[:cut], f[:cut])
            rest_k, rest_f = k[cut:], f[cut:]
        yield from links(rest_k, rest_f)

    dealt = keyed.repartition(spread(keyed.sparkSession), "key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "u long, v long")


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (fps.fp, one row each) that span all links of ``distance`` bits."""
    blocks, keep = _layout(distance)
    masks = _masks(list(range(64)), blocks, keep)
    files = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(m).alias("mask")) for i, m in enumerate(masks)])
    filed = fps.select("fp", F.explode(files).alias("x"))
    keyed = filed.select(F.xxhash64("x.c", F.col("fp").bitwiseAND(F.col("x.mask"))).alias("key"), F.col("x.c").alias("c"), "fp")
    hot = staged(keyed.groupBy("key").count().where(F.col("count") > BUCKET).select("key"), "hot-keys")
    if not hot.limit(1).count():
        return _edges(keyed.select("key", "fp"), distance)
    finer = []
    for c, m in enumerate(masks):
        rest = [b for b in range(64) if not (m >> b) & 1]
        sub = _masks(rest, blocks, keep)
        finer.append(F.array(*[F.struct(F.lit(i).alias("c2"), F.lit(s).alias("mask2")) for i, s in enumerate(sub)]))
    again = keyed.join(hot, "key", "left_semi").select(
        "key", "fp", F.explode(F.element_at(F.array(*finer), F.col("c") + 1)).alias("y")
    )
    cold = keyed.join(hot, "key", "left_anti").select("key", "fp")
    hotter = again.select(F.xxhash64("key", "y.c2", F.col("fp").bitwiseAND(F.col("y.mask2"))).alias("key"), "fp")
    return _edges(cold.unionByName(hotter), distance)


def near_duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links, the document's own included.

    One row per input row, repeated rows and ids included. Null and word-free texts have fingerprint zero and are linked
    like any other. A null doc_id stays null and never becomes a component_id unless its component has no other id. An
    empty table gives an empty result; other columns are ignored.
    """
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    groups = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-groups")
    roots = connected_components(links(groups.select("fp"), distance)).withColumnRenamed("node", "fp")
    rooted = groups.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(labels, "fp").select("doc_id", "fp", "component_id")


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    from cadastra.llm.common import table

    found = near_duplicate_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
