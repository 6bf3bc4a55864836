"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, one kept of each group.

SimHash alone cannot find them: at 0.8 two fingerprints differ in about ten of 64 bits, and pigeonhole blocks for such a
distance are too short to tell documents apart. So candidates come from two sides, and only exact similarity links:

1. Documents of one shingle set become one row, with its fingerprint and the keys of ``BANDS`` bands of ``ROWS`` minima
   (a pair at 0.8 shares no band with a chance of 2e-5, one at 0.4 shares one with a chance of 0.14).
2. Rows that share a band or have fingerprints within ``distance`` bits are joined to candidate components.
3. Each component's sets meet once, and a search over their inverted index gives the exact groups within it.

Copies never meet each other, and no pairs are written: a band gives one edge a row, to the smallest row of the band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import discard, spread, staged, text_bytes
from cadastra.llm.components import connected_components
from cadastra.llm.simhash import SEED, _fingerprint, _signed, links, shingle_hashes

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 36, 6
#: Shingles that are hashed to minima at once.
CHUNK = 1 << 11
_RANDOM = np.random.default_rng(SEED)
_FLIP, _TIMES = (_RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) for _ in range(2))
_TIMES |= np.uint64(1)


def _band_keys(hashes: np.ndarray) -> list[int]:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), CHUNK):
        least = np.minimum(least, ((hashes[at : at + CHUNK] ^ _FLIP) * _TIMES).min(axis=1))
    return [_signed(xxhash.xxh64_intdigest(band.tobytes(), i)) for i, band in enumerate(least.reshape(BANDS, ROWS))]


def _tie(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col)).alias("tie")


def _sets(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, tie, sid, fp, keys, shingles, row) as staged, one row per input row; sid is a hash of the sorted distinct shingle
    hashes, tie one of the text that tells rows of one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sids, fps, keys, packed = [], [], [], []
            for x in b.column(2):
                raw = shingle_hashes(x.as_buffer().to_pybytes(), shingle)
                own = np.unique(raw)
                packed.append(own.tobytes())
                sids.append(_signed(xxhash.xxh64_intdigest(packed[-1], SEED)))
                fps.append(_signed(_fingerprint(raw)))
                keys.append(_band_keys(own) if len(own) else [])
            cols = [pa.array(sids, pa.int64()), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["doc_id", "tie", "sid", "fp", "keys", "shingles"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), _tie(text_col), text_bytes(text_col).alias("t"))
    made = narrow.mapInArrow(run, "doc_id long, tie long, sid long, fp long, keys array<long>, shingles binary")
    return staged(made.withColumn("row", F.monotonically_increasing_id()), "near-sets")


def _candidates(rows: DataFrame, distance: int) -> DataFrame:
    """rows(sid, fp, keys), one of each sid -> edges (u, v) that join all rows of a band or of near fingerprints."""
    keyed = rows.select("sid", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("sid").alias("v"), F.max("sid").alias("top")).where("v < top").select("key", "v")
    bands = keyed.join(staged(shared, "near-bands"), "key").select(F.col("sid").alias("u"), "v")
    some = rows.where(F.size("keys") > 0)
    prints = staged(some.groupBy("fp").agg(F.min("sid").alias("v")), "near-prints")
    equal = some.join(prints, "fp").select(F.col("sid").alias("u"), "v")
    near = links(prints.select("fp"), distance).withColumnsRenamed({"u": "fu", "v": "fv"})
    name = lambda c, to: prints.select(F.col("fp").alias(c), F.col("v").alias(to))
    wide = near.join(name("fu", "u"), "fu").join(name("fv", "v"), "fv").select("u", "v")
    return bands.unionByName(equal).unionByName(wide).where("u <> v").distinct()


def similar_groups(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Number of the group of each set (of distinct values): sets of that Jaccard similarity are in one group.

    Breadth first over an inverted index of the sets not reached yet, which is built anew whenever half are reached.
    """
    size = np.array([len(x) for x in sets])
    group, queue, n = np.full(len(sets), -1), [], 0
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    left = at_build = len(sets)
    while left:
        if queue:
            at = queue.pop()
        else:
            at = int(np.argmax(group < 0))
            group[at], n, left = n, n + 1, left - 1
        lo, hi = np.searchsorted(values, sets[at], "left"), np.searchsorted(values, sets[at], "right")
        count = hi - lo
        place = np.repeat(lo - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        who, both = np.unique(owner[place], return_counts=True)
        near = who[(group[who] < 0) & (both >= similarity * (size[at] + size[who] - both) - 1e-9)]
        group[near] = group[at]
        queue.extend(near.tolist())
        left -= len(near)
        if 2 * left < at_build:
            rest = group[owner] < 0
            values, owner, at_build = values[rest], owner[rest], left
    return group


def _groups(members: DataFrame, similarity: float) -> DataFrame:
    """members(root, sid, least, shingles) -> (sid, component_id, component_tie); a candidate component is one run of a
    sorted partition."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        firsts = [(r[1]["last"], r[1]["doc_id"] or 0, r[1]["tie"]) for r in rows]
        group, best = similar_groups([np.frombuffer(r[2], "<u8") for r in rows], similarity).tolist(), {}
        for g, first in zip(group, firsts, strict=True):
            best[g] = min(first, best.get(g, first))
        won = [best[g] for g in group]
        cols = [[r[0] for r in rows], [None if last else i for last, i, _ in won], [tie for *_, tie in won]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["sid", "component_id", "component_tie"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for b in batches:
            for root, *row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if root != now and rows:
                    yield settle(rows)
                    rows = []
                now = root
                rows.append(row)
        if rows:
            yield settle(rows)

    dealt = members.select("root", "sid", "least", "shingles").repartition(spread(members.sparkSession), "root").sortWithinPartitions("root", "sid")
    return dealt.mapInArrow(run, "sid long, component_id long, component_tie long")


def _labelled(sets: DataFrame, similarity: float, distance: int) -> DataFrame:
    """sets(row, ...) as staged -> (sid, component_id, component_tie), one row of each sid: the id and tie of the component's
    first row, null ids last. Of copies only one row's set moves."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie")
    named = staged(sets.groupBy("sid").agg(F.min(order).alias("least"), F.min("row").alias("row")), "near-names")
    firsts = staged(sets.select("row", "sid", "fp", "keys").join(named.select("row"), "row", "left_semi"), "near-rows")
    roots = connected_components(_candidates(firsts, distance)).withColumnRenamed("node", "sid")
    members = sets.select("row", "shingles").join(named.join(roots, "sid"), "row")
    found = staged(_groups(members, similarity), "near-groups")
    discard(firsts)
    met = named.select("sid", "least").join(found.withColumn("met", F.lit(True)), "sid", "left")
    own = lambda c, of: F.when(F.col("met"), F.col(c)).otherwise(F.col(f"least.{of}")).alias(c)
    return met.select("sid", own("component_id", "doc_id"), own("component_tie", "tie"))


def near_copy_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, distance: int = 3
) -> DataFrame:
    """(doc_id, component_id), one row per input row: the smallest doc_id reachable over similar documents.

    Null and word-free texts are copies of each other. A null doc_id stays null and never becomes a component_id unless
    its component has no other id. An empty table gives an empty result; other columns are ignored.
    """
    sets = _sets(docs, id_col, text_col, shingle)
    return sets.select("doc_id", "sid").join(_labelled(sets, similarity, distance), "sid").select("doc_id", "component_id")


def keep_one_copy(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, distance: int = 3
) -> DataFrame:
    """One row of docs of each group of near copies: that of the smallest id, null ids last, and by a hash of the text where
    an id has several texts in the group. Of rows equal in id and text any one stays.

    Different texts under one id are different documents, also under a null id. Columns are those of docs; an empty table
    gives an empty result.
    """
    sets = _sets(docs, id_col, text_col, shingle)
    labels = _labelled(sets, similarity, distance)
    discard(sets)
    # no nulls among the keys: then rows are dealt once, for the duplicates and for the join
    key = lambda i, tie: {"__id": F.coalesce(i, F.lit(0)), "__none": i.isNull(), "__tie": tie}
    stay = labels.select(*[c.alias(n) for n, c in key(F.col("component_id"), F.col("component_tie")).items()]).distinct()
    own = docs.withColumns(key(F.col(id_col).cast("long"), _tie(text_col)))
    return own.dropDuplicates(stay.columns).join(stay, stay.columns, "left_semi").select(*docs.columns)
