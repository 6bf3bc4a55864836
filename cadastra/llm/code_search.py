"""Exact top-k search over 64-bit binary codes by incremental multi-index hashing.

Distinct codes are dealt over shards by a hash. A shard cuts its codes into ``m`` segments of about log2(codes) bits, each
an index key (Norouzi et al., "Fast Search in Hamming Space with Multi-Index Hashing", 2012). A query grows one segment's
radius at a time: in step t, segment t mod m is probed at exactly t div m bits. All codes within t bits have then been
met, so the query closes once k of them are verified, and its result there is provably whole. A step whose masks would
outnumber the segment's own keys compares the keys instead; both find the same codes.

Shards are searched in waves, each eight times as wide as all before. What a query has found so far bounds its search in
the next wave, so the many shards of a large table are left after a few steps. Queries and shards meet in blocks of
bounded size; nothing is broadcast or collected, and the driver sees counts only.

Equal codes are one row: a code brings its k + 1 smallest ids only, which a partial limit finds before any shuffle, so one
very common vector costs no more than any other. Queries with one code are searched once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import discard, spread, staged, table

BITS = 64
K = 10
#: Codes of a shard and queries of a block at most (on average); smaller ones where the cluster would be idle.
SHARD, BLOCK, LEAST_BLOCK = 1 << 20, 1 << 18, 64
#: Keys and candidates that are held at once.
HELD = 1 << 21


def sign_codes(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Codes of vectors that lie one after the other in values, of the given sizes.

    Bit b is set if the components b, b + 64, b + 128, ... add up to more than 0; NaN counts as 0.
    """
    start = np.cumsum(size) - size
    at = np.arange(len(values)) - np.repeat(start, size)
    place = np.repeat(np.arange(len(size)) * BITS, size) + at % BITS
    total = np.bincount(place, weights=np.nan_to_num(values, nan=0.0), minlength=len(size) * BITS)
    return np.packbits(total.reshape(-1, BITS) > 0, axis=1, bitorder="little").view("<i8")[:, 0]


def codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code) of the rows with an id and a vector; nulls within a vector count as 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            values = lists.flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sign_codes(values, size), pa.int64())], names=["id", "code"])

    some = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    narrow = some.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return narrow.mapInArrow(run, "id long, code long")


def _masks(width: int, radius: int) -> np.ndarray:
    """All numbers of width bits with exactly radius bits set, by Gosper's step on whole arrays of prefixes."""
    found = np.zeros(1, np.uint64)
    lowest = np.full(1, width)
    for _ in range(radius):
        count = lowest
        parent = np.repeat(np.arange(len(found)), count)
        bit = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found, lowest = found[parent] | (np.uint64(1) << bit.astype(np.uint64)), bit
    return found


class Shard:
    """A multi-index over distinct codes (unsigned)."""

    def __init__(self, code: np.ndarray, least: np.ndarray):
        self.code, self.least = code, least
        self.m = min(16, max(2, round(BITS / max(1.0, math.log2(len(code) + 1)))))
        edge = [BITS * s // self.m for s in range(self.m + 1)]
        self.shift, self.width = edge[:-1], [b - a for a, b in zip(edge, edge[1:], strict=False)]
        self.order, self.keys, self.start = [], [], []
        for s in range(self.m):
            key = self.segment(code, s)
            order = np.argsort(key, kind="stable")
            keys, start = np.unique(key[order], return_index=True)
            self.order.append(order)
            self.keys.append(keys)
            self.start.append(np.r_[start, len(code)])

    def segment(self, code: np.ndarray, s: int) -> np.ndarray:
        return (code >> np.uint64(self.shift[s])) & np.uint64((1 << self.width[s]) - 1)

    def _probe(self, own: np.ndarray, s: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query number, place of a code) of all codes whose segment s lies at exactly radius bits from the query's."""
        keys, start, order = self.keys[s], self.start[s], self.order[s]
        dense = math.comb(self.width[s], radius) >= len(keys)
        masks = keys if dense else _masks(self.width[s], radius)
        rows = max(1, HELD // len(masks))
        for lo in range(0, len(own), rows):
            wanted = own[lo : lo + rows, None] ^ masks
            if dense:
                query, key = np.nonzero(np.bitwise_count(wanted) == radius)
            else:
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                query, col = np.nonzero(keys[at] == wanted)
                key = at[query, col]
            count = start[key + 1] - start[key]
            for part in np.split(np.arange(len(key)), np.flatnonzero(np.diff(np.cumsum(count) // HELD)) + 1):
                n, first = count[part], start[key[part]]
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield lo + np.repeat(query[part], n), order[np.repeat(first, n) + inside]

    def search(self, queries: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, place, distance): each query's k nearest codes here within bound, ties by least id."""
        seen = np.zeros((len(queries), BITS + 1), np.int32)
        kept = [np.zeros((3, 0), np.int64)]
        held = 0
        opened = np.arange(len(queries))
        for t in range(BITS + self.m):
            s, radius = t % self.m, t // self.m
            if not len(opened):
                break
            if radius > self.width[s]:
                continue
            for q, place in self._probe(self.segment(queries[opened], s), s, radius):
                q = opened[q]
                apart = queries[q] ^ self.code[place]
                first = np.ones(len(q), bool)
                for o in range(self.m):
                    if o != s:
                        first &= np.bitwise_count(self.segment(apart, o)) * self.m + o > t
                q, place = q[first], place[first]
                far = np.bitwise_count(apart[first]).astype(np.int64)
                near = far <= bound[q]
                q, place, far = q[near], place[near], far[near]
                np.add.at(seen, (q, far), 1)
                kept.append(np.stack([q, place, far]))
                held += len(q)
                if held > 4 * HELD:
                    kept = [self._nearest(np.concatenate(kept, axis=1), k)]
                    held = kept[0].shape[1] - HELD
            done = (seen[opened, : min(t, BITS) + 1].sum(1) >= k) | (bound[opened] <= t) | (seen[opened].sum(1) == len(self.code))
            opened = opened[~done]
        return tuple(self._nearest(np.concatenate(kept, axis=1), k))

    def _nearest(self, met: np.ndarray, k: int) -> np.ndarray:
        q, place, far = met
        order = np.lexsort((self.least[place], far, q))
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        return met[:, order[rank < k]]


def _search_blocks(index: DataFrame, asked: DataFrame, shards: range, blocks: int, k: int) -> DataFrame:
    """(query_code, code, distance, least): each query's k nearest codes in each of the shards, within its bound."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        if len(left) and len(right):
            code, least = (left.column(c).to_numpy() for c in ("code", "least"))
            query, bound = (right.column(c).to_numpy() for c in ("query_code", "bound"))
            q, place, far = Shard(code.view(np.uint64), least).search(query.view(np.uint64), k, bound)
            out = [query[q], code[place], far, least[place]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        return pa.table([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["query_code", "code", "distance", "least"])

    of_wave = index.where(F.col("shard").between(shards.start, shards.stop - 1))
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    every = F.explode(F.sequence(F.lit(shards.start), F.lit(shards.stop - 1))).alias("shard")
    met = of_wave.select("shard", each, "code", "least").groupBy("shard", "block").cogroup(
        asked.select(every, "block", "query_code", "bound").groupBy("shard", "block")
    )
    return met.applyInArrow(run, "query_code long, code long, distance int, least long")


def search_codes(base: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """base(id, code), queries(id, code) -> (query_id, rank, neighbour_id, distance), k rows for each query row.

    Exact: the k nearest by Hamming distance, ties by id, the query's own id left out. With fewer than k other ids, all
    of them. Repeated rows of base count once; repeated queries give repeated results; other columns are ignored. Rows of
    base without an id or a code, and queries without a code, are left out; a query without an id leaves none out. Empty
    inputs give no rows.
    """
    spark = base.sparkSession
    rows = staged(base.select("id", "code").where("id IS NOT NULL AND code IS NOT NULL").distinct(), "codes")
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    members = staged(rows.withColumn("n", place).where(F.col("n") <= k + 1).drop("n"), "members")
    narrow = queries.select("id", "code").where("code IS NOT NULL")
    distinct = members.groupBy("code").agg(F.min("id").alias("least"))
    n, asked = distinct.count(), narrow.select("code").distinct().count()
    if not n or not asked:
        return spark.createDataFrame([], "query_id long, rank int, neighbour_id long, distance int")
    shards = -(-n // shard)
    blocks = max(-(-asked // block), min(-(-asked // LEAST_BLOCK), -(-spread(spark) // shards)))
    index = staged(distinct.withColumn("shard", F.pmod(F.xxhash64("code", F.lit(1)), F.lit(shards)).cast("int")), "index")
    number = F.pmod(F.xxhash64("query_code", F.lit(2)), F.lit(blocks)).cast("int")
    opened = staged(narrow.select(F.col("code").alias("query_code")).distinct().withColumn("block", number), "open")
    nearest = Window.partitionBy("query_code").orderBy("distance", "least")
    best, done = None, 0
    while done < shards:
        wave = range(done, min(shards, max(1, 8 * done) if shards > 8 else shards))
        if best is None:
            bounded = opened.withColumn("bound", F.lit(BITS))
        else:
            full = best.groupBy("query_code").agg(F.when(F.count(F.lit(1)) > k, F.max("distance")).alias("far"))
            bounded = opened.join(full, "query_code", "left").withColumn("bound", F.coalesce("far", F.lit(BITS))).drop("far")
        found = _search_blocks(index, bounded, wave, blocks, k + 1)
        every = found if best is None else found.unionByName(best)
        now = staged(every.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).drop("n"), "best")
        discard(best)
        best, done = now, wave.stop
    told = narrow.select(F.col("id").alias("query_id"), F.col("code").alias("query_code"), F.monotonically_increasing_id().alias("row"))
    met = staged(told, "queries").join(best.join(members, "code").select("query_code", "id", "distance"), "query_code")
    rank = F.row_number().over(Window.partitionBy("row").orderBy("distance", "id"))
    others = met.where(~F.col("id").eqNullSafe(F.col("query_id")))
    out = others.select("query_id", rank.alias("rank"), F.col("id").alias("neighbour_id"), "distance").where(F.col("rank") <= k)
    return out


def op5_hamming_top_k(spark, sf_dir: str) -> DataFrame:
    base = staged(codes(table(spark, sf_dir, "embeddings")), "codes")
    return search_codes(base, base.where(F.col("id") % 100 == 0))
