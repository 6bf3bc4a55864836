"""Small predicates and conversions of coverage, comparison metrics, edit logs and lists, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds of the causes of a difference between two shapes.
COVERED, SMALL, LARGE, FAR, LITTLE = 0.7, 0.6, 1.6, 400.0, 0.2


def has_coverage(whole: Column, intervals: Column, singles: Column, bez_broja: Column) -> Column:
    """A clause claims something: the whole street, ranges, numbers, or houses without one. Nulls claim nothing."""
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    flag = lambda c: F.coalesce(c.cast("boolean"), F.lit(False))
    return flag(whole) | some(intervals) | some(singles) | flag(bez_broja)


def weak_substring(method: Column, name: Column, matched: Column) -> Column:
    """A fuzzy match of a single word that stands in the matched name, but not in front."""
    place = F.array_position(F.split(matched, " "), name)
    return F.coalesce((method == "fuzzy") & (name != "") & ~name.contains(" ") & (place > 1), F.lit(False))


def cause(iou: Column, ratio: Column, cover_theirs: Column, cover_ours: Column, apart: Column) -> Column:
    """Why two shapes differ, told by the first measure that is out of bounds."""
    return (
        F.when((cover_theirs >= COVERED) & (ratio < SMALL), "ours_much_smaller").when((cover_ours >= COVERED) & (ratio > LARGE), "ours_much_larger")
        .when(apart > FAR, "centres_apart").when(iou < LITTLE, "little_shared").otherwise("partial_shift")
    )


def json_or(text: Column, schema: str, default: Column) -> Column:
    """A JSON text as a value of the schema; the default where it is null or no such JSON."""
    wrapped = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"struct<v:{schema},_bad:string>", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return F.when(wrapped["_bad"].isNull() & wrapped["v"].isNotNull(), wrapped["v"]).otherwise(default)


def iso_utc(stamp: Column) -> Column:
    """A timestamp as ISO 8601 in UTC, to the second."""
    return F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def without_values(values: Column, gone: Column) -> Column:
    """The values that are not among the others, repeats kept."""
    return F.filter(values, lambda v: ~F.exists(gone, lambda g: g.eqNullSafe(v)))
