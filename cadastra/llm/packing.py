"""Best-fit packing of tokenized documents into fixed-length sequences, with certified and repaired partitions.

Pieces are dealt over packing groups of about ``GROUP`` pieces, each packed by best-fit decreasing. Dual feasible
functions give each group a lower bound on its sequences; a group that meets its bound is certified. The pieces in
sequences with room of all other groups are pooled, dealt anew and packed again, as long as that saves sequences (or as often as the caller allows).

Tokens come from a vocabulary that cuts at white space, so the ids of a text are those of its words in turn. Texts of
about ``CHUNK`` characters are looked at together, and each of their words is tokenized once.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, count
from unicodedata import category

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import discard, staged, table

CAPACITY = 2048
GROUP = 20_000
#: Code points of texts whose words are looked up at once.
CHUNK = 1 << 23


class WordTokens:
    """Token ids (little-endian unsigned 32-bit) of texts, by way of their distinct words; keeps nothing between calls.

    Words of printable Latin letters, digits and signs are cut as the vocabulary's own splitting pattern cuts them and
    merged all at once over bytes, with a space for the vocabulary's mark of a word's end: joining that mark to the last
    byte comes before all merges, which keep their order. Ranking joined bytes instead of pairs gives the same tokens as
    long as each token's own bytes merge into it, which a test holds for the whole vocabulary. All other words, and those
    that could hold a special token, go to the tokenizer one by one.
    """

    #: The splitting pattern and the mark stated in the vocabulary's file.
    PART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    END = "</w>"
    #: Characters from here on are left to the tokenizer; so are those that do not print, and one that grows in lower case.
    FOREIGN, GROWS = 0x180, 0x130
    SPACE, LETTER, DIGIT, SIGN, QUOTE, ODD = range(6)
    #: Distinct words that are cut and merged at once; the arrays of their characters are what takes memory.
    WORDS = 1 << 14

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.find = regex.compile(self.PART).findall
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of = _byte_alphabet()

        def raw(token: str) -> bytes:
            ends = token.endswith(self.END)
            return bytes(byte_of[c] for c in token[: -len(self.END) if ends else None]) + b" " * ends

        ranks = {bytes([b, 32]): b for b in range(256)} | {bytes([b]): 256 + b for b in range(256)}
        for n, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks[raw(left) + raw(right)] = 512 + n
        self.merge = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        size = max(ranks.values()) + 1
        self.id_of, self.ends = np.zeros(size, "<u4"), np.zeros(size, bool)
        id_of = {raw(t): i for t, i in model["vocab"].items() if set(t.removesuffix(self.END)) <= byte_of.keys()}
        for token, rank in ranks.items():
            self.id_of[rank], self.ends[rank] = id_of[token], token.endswith(b" ")
        self.kind = np.array([self._kind(c) for c in range(self.FOREIGN + 1)], np.uint8)

    def _kind(self, code: int) -> int:
        c = chr(code)
        if code in (self.FOREIGN, self.GROWS) or not c.isprintable():
            return self.ODD
        if c in " '":
            return self.SPACE if c == " " else self.QUOTE
        return self.LETTER if c.isalpha() else self.DIGIT if category(c)[0] == "N" else self.SIGN

    def _kinds(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        return code, self.kind[np.minimum(code, self.FOREIGN)]

    def _merged(self, parts: str, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, each with a space behind it, and the number of ids up to each word of so many parts."""
        ranks = np.array(self.merge(parts), np.int64)
        stops = np.r_[0, np.flatnonzero(self.ends[ranks]) + 1]
        if len(stops) != count.sum() + 1:
            raise ValueError("the vocabulary does not end each part by a token of its own")
        return self.id_of[ranks], stops[np.cumsum(count)]

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters, digits and signs: a part is a run of letters, of signs, or one digit."""
        low = " ".join(words).lower()
        code, kind = self._kinds(low + " ")
        inner = np.flatnonzero(kind != self.SPACE)
        last = (kind[inner] != kind[inner + 1]) | (kind[inner] == self.DIGIT)
        word = np.cumsum(kind == self.SPACE)[inner]
        out = np.full(len(inner) + last.sum(), 32, "<u4")
        out[np.arange(len(inner)) + np.cumsum(last) - last] = code[inner]
        return self._merged(out.tobytes().decode("utf-32-le"), np.bincount(word[last], minlength=len(words)))

    def _of_words(self, words: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Ids of words as binary values, and the place of each word among them."""
        code, kind = self._kinds(" ".join(words))
        number = np.cumsum(kind == self.SPACE)
        quoted, odd = np.zeros(len(words), bool), np.zeros(len(words), bool)
        quoted[number[kind == self.QUOTE]] = True
        odd[number[kind == self.ODD]] = True
        odd[number[:-1][(code[:-1] == ord("<")) & (code[1:] == ord("|"))]] = True
        way = np.where(odd, 2, quoted)
        of_way = [list(compress(words, (way == w).tolist())) for w in range(3)]
        cut = [self.find(w.lower()) for w in of_way[1]]
        ids, ends = [], []
        for found, end in (
            self._plain(of_way[0]),
            self._merged("".join([p + " " for ps in cut for p in ps]), np.array([len(ps) for ps in cut], np.int64)),
            self._foreign(of_way[2]),
        ):
            ends.append(end + sum(map(len, ids)))
            ids.append(found)
        offsets = pa.py_buffer(np.r_[0, np.concatenate(ends) * 4].astype(np.int32))
        values = pa.Array.from_buffers(pa.binary(), len(words), [None, offsets, pa.py_buffer(np.concatenate(ids).tobytes())])
        place = np.empty(len(words), np.int64)
        place[np.argsort(way, kind="stable")] = np.arange(len(words))
        return values, place

    def _foreign(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)] if words else []
        return np.fromiter(chain.from_iterable(found), "<u4"), np.cumsum([len(x) for x in found], dtype=np.int64)

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        known, runs, places = words.dictionary, [], []
        for at in range(0, max(1, len(known)), self.WORDS):
            values, place = self._of_words(known.slice(at, self.WORDS).to_pylist())
            runs.append(values)
            places.append(place + at)
        place = np.concatenate(places)
        taken = pa.concat_arrays(runs).take(pa.array(place[words.indices.to_numpy()]))
        ends = np.frombuffer(taken.buffers()[1], np.int32)[split.offsets.to_numpy()].tolist()
        data = memoryview(taken.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of the vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b > 173]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One vocabulary for all tasks that a Python worker runs."""
    return WordTokens(path)


def pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 0, keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the token ids of each row's text and end_id, cut at capacity.

    Null texts count as empty; a document of no token is one piece with end_id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, width, end = word_tokens(tokenizer_path), 4 * capacity, array("I", [end_id]).tobytes()

        def cut(ids: list, texts: list[str]) -> pa.RecordBatch:
            rows: list[tuple] = []
            for i, raw in zip(ids, tokens(texts), strict=True):
                raw += end
                for k, at in enumerate(range(0, len(raw), width)):
                    part = raw[at : at + width]
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
            cols = list(zip(*rows, strict=True))
            kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, kinds, strict=True)], names=[n for n, _ in kinds])

        for b in batches:
            ids, texts, held = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                texts.append(t.as_py() or "")
                ids.append(i)
                held += len(texts[-1])
                if held > CHUNK:
                    yield cut(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield cut(ids, texts)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    out = narrow.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if keep_ids else out.drop("ids")


def best_fit_decreasing(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item, and the number of bins; open bins wait in one stack per free space."""
    order = np.argsort(-length, kind="stable")
    stacks: dict[int, list[int]] = {}
    free_set, bins = 0, 0
    which, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    for i, n in zip(order.tolist(), length[order].tolist(), strict=True):
        fits = free_set >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            stack = stacks[free]
            b = stack.pop()
            if not stack:
                free_set ^= 1 << free
        else:
            free, b = capacity, bins
            bins += 1
        which[i], offset[i] = b, capacity - free
        free -= n
        if free:
            stacks.setdefault(free, []).append(b)
            free_set |= 1 << free
    return which, offset, bins


def lower_bound(length: np.ndarray, capacity: int) -> int:
    """The best of two families of dual feasible functions, evaluated on the histogram of lengths.

    Rounding at a threshold t: lengths over capacity - t count as capacity, those under t as nothing. Stepping by k: a
    length counts floor((k + 1) * length / capacity) / k of the capacity, or itself where the step is exact.
    """
    x = np.arange(capacity + 1)
    count = np.bincount(length, minlength=capacity + 1)
    n, mass = np.cumsum(count), np.cumsum(count * x)
    t = np.arange(0, capacity // 2 + 1)
    big = n[capacity] - n[capacity - t]
    middle = mass[capacity - t] - np.where(t > 0, mass[np.maximum(t - 1, 0)], 0)
    best = int(np.max(-(-(big * capacity + middle) // capacity)))
    for k in range(1, 40):
        step = (k + 1) * x
        twice = np.where(step % capacity == 0, x * k, step // capacity * capacity)  # times k, to stay in integers
        best = max(best, -(-int((twice * count).sum()) // (capacity * k)))
    return best


def _pack(rows: DataFrame, capacity: int, number: int) -> DataFrame:
    """Pack each packing group of rows; adds seq, offset, room (of the sequence), bins and bound (of the group)."""
    base = number << 56

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        length = pdf["length"].to_numpy(np.int64)
        which, offset, bins = best_fit_decreasing(length, capacity)
        room = capacity - np.bincount(which, weights=length, minlength=bins).astype(np.int64)
        seq = base + (pdf["grp"].to_numpy(np.int64) << 30) + which
        return pdf.assign(seq=seq, offset=offset, room=room[which], bins=bins, bound=lower_bound(length, capacity))

    kept = "doc_id long, piece int, start long, length long, ids_crc32 long, row long, grp long"
    return rows.groupBy("grp").applyInPandas(one, f"{kept}, seq long, offset long, room long, bins long, bound long")


def pack_pieces(found: DataFrame, capacity: int = CAPACITY, group: int = GROUP, rounds: int | None = None) -> DataFrame:
    """found(doc_id, piece, start, length, ids_crc32, row) -> plus sequence_id and offset; found must be a staged table.

    A group holds about ``group`` pieces at any size of the input: rows are dealt by their row number, so copies and
    repeated rows spread like others. Every length must be between 1 and capacity. Sequences with room are pooled and
    packed again until that saves none, or ``rounds`` times at most.
    """
    n = found.count()
    deal = lambda r, total: F.pmod(F.xxhash64(F.lit(r), "row"), F.lit(max(1, -(-total // group))))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]
    done, open_rows = [], staged(_pack(found.select(*kept).withColumn("grp", deal(0, n)), capacity, 0), "packed")
    for r in count(1):
        gap = (F.col("bins") > F.col("bound")) & (F.col("room") > 0)
        pooled = open_rows.where(gap).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("seq").alias("bins")).first()
        if not pooled["n"] or r > (r if rounds is None else rounds):
            break
        again = open_rows.where(gap).select(*kept)
        packed = staged(_pack(again.withColumn("grp", deal(r, pooled["n"])), capacity, r), "packed")
        if packed.agg(F.count_distinct("seq")).first()[0] >= pooled["bins"]:
            discard(packed)
            break
        done.append(staged(open_rows.where(~gap), "done"))
        discard(open_rows)
        open_rows = packed
    out = open_rows
    for part in done:
        out = out.unionByName(part)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset", "row")


def numbered(found: DataFrame) -> DataFrame:
    """Pieces as a staged table in which each has a row number of its own, which repeated rows of a document differ in."""
    return staged(found.withColumn("row", F.monotonically_increasing_id()), "pieces")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group: int = GROUP, rounds: int | None = None, **kwargs
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, row.

    Only documents of more than capacity tokens are cut. Repeated rows and ids are packed row by row, and ``row`` tells
    their pieces apart; null texts count as empty ones, null ids stay. An empty table gives an empty result; other columns
    are ignored. The ids themselves come from ``pieces(keep_ids=True)``, ``numbered`` and ``sequences``.
    """
    return pack_pieces(numbered(pieces(docs, tokenizer_path, capacity, **kwargs)), capacity, group, rounds)


def sequences(packed: DataFrame, found: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence in order, at most capacity of them.

    found is the numbered table with ids that packed was made of.
    """
    met = packed.select("sequence_id", "offset", "row").join(found.select("row", "ids"), "row")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    blank = F.lit(b"").cast("binary")
    return met.groupBy("sequence_id").agg(F.aggregate(ordered, blank, lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def word_bpe() -> str:
    """The default vocabulary's file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_bpe())
