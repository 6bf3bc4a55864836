"""House numbers: suffix order, parity and the predicates of numbered claims, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the letters of house suffixes in their alphabet's order.
SUFFIX_ORDER = "АБВГДЂЕЖЗИЈКЛЉМНЊОПРСТЋУФХЦЧЏШ"
#: Upper bound of an open-ended range, as it appears in outputs.
OPEN_END = 100_000
INTERVAL_TYPE = "struct<lo:bigint,hi:bigint,parity:string,lo_sfx:string,hi_sfx:string>"
SINGLE_TYPE = "struct<num:bigint,suffix:string>"


def suffix_rank(suffix: Column) -> Column:
    """array<int> whose order is that of suffixes: empty first, then the alphabet, then other characters by code."""
    chars = F.filter(F.split(F.coalesce(suffix, F.lit("")), ""), lambda c: c != F.lit(""))
    place = lambda c: F.instr(F.lit(SUFFIX_ORDER), c)
    return F.transform(chars, lambda c: F.when(place(c) > 0, place(c) - 1).otherwise(F.ascii(c) + 100).cast("int"))


def interval_parity(lo: Column, hi: Column) -> Column:
    return F.when((lo % 2 == 1) & (hi % 2 == 1), "odd").when((lo % 2 == 0) & (hi % 2 == 0), "even").otherwise("all")


def parity_ok(num: Column, parity: Column) -> Column:
    return (parity == "all") | ((parity == "odd") & (num % 2 == 1)) | ((parity == "even") & (num % 2 == 0))


def bounds_ok(num: Column, rank: Column, lo: Column, hi: Column, lo_rank: Column, hi_rank: Column) -> Column:
    """A bound with a suffix cuts the suffixes at its number; a bare bound takes them all."""
    low = (num == lo) & (F.size(lo_rank) > 0) & (rank < lo_rank)
    high = (num == hi) & (F.size(hi_rank) > 0) & (rank > hi_rank)
    return ~low & ~high
