"""Changes between versions of a table: delta actions, scoped merges, edit logs, upserts and change classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.grammar import NUMBER_LISTS, explode_segments, number_lists
from cadastra.functions.predicates import json_or, without_values
from cadastra.functions.text import normalize_street


def row_signature(df: DataFrame, cols: list[str], digits: int = 4):
    """Content hash of some columns: nulls are told from empty strings, doubles are compared to ``digits`` places."""
    kinds = dict(df.dtypes)
    text = lambda c: (F.round(F.col(c), digits) if kinds[c] in ("double", "float") else F.col(c)).cast("string")
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(text(c), F.lit("\\N")) for c in cols]), 256)


def delta(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """(key, action): U for new or changed rows, D for vanished ones; unchanged rows do not appear.

    One full outer join of narrow signatures. Comparing a version with itself gives nothing, so a rerun is safe.
    """
    sig = lambda df, name: df.select(key, row_signature(df, cols).alias(name))
    met = sig(old, "before").join(sig(new, "after"), key, "full_outer")
    action = F.when(F.col("after").isNull(), "D").when(F.col("before").isNull() | (F.col("before") != F.col("after")), "U")
    return met.select(key, action.alias("action")).where("action IS NOT NULL")


def scoped_merge(previous: DataFrame, fresh: DataFrame, affected: DataFrame, scope: str) -> DataFrame:
    """previous without the affected scopes' rows, plus the fresh rows of these; all else is kept as it was."""
    kept = previous.join(affected.select(scope).distinct(), scope, "left_anti")
    return kept.unionByName(fresh.join(affected.select(scope).distinct(), scope, "left_semi"), allowMissingColumns=True)


def reconcile(stations: DataFrame, texts: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Pristine stations with reviewers' edits: added ones joined, texts overridden, tombstones taken out last."""
    alive = stations.unionByName(added, allowMissingColumns=True).join(removed.select("station_id"), "station_id", "left_anti")
    new_text = texts.select("station_id", F.col("raw_coverage_text").alias("__text"))
    out = alive.join(new_text, "station_id", "left")
    return out.withColumn("raw_coverage_text", F.coalesce("__text", "raw_coverage_text")).drop("__text")


def upsert_greatest(table: DataFrame, changes: DataFrame, key: str, greatest: list[str], latest: list[str]) -> DataFrame:
    """Full outer merge: some columns keep the greater value, others take the change's where it has one."""
    new = changes.withColumnsRenamed({c: f"__{c}" for c in changes.columns if c != key})
    met = table.join(new, key, "full_outer")
    big = [F.greatest(F.col(c), F.col(f"__{c}")).alias(c) for c in greatest]
    return met.select(key, *big, *[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) for c in latest])


def last_write(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key in an explicit order."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return log.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def clear_unchanged(dirty: DataFrame, snapshot: DataFrame, key: str, stamp: str) -> DataFrame:
    """Dirty marks that stay: those touched since the snapshot, or not in it."""
    seen = snapshot.select(key, F.col(stamp).alias("__seen"))
    return dirty.join(seen, key, "left").where(F.col("__seen").isNull() | (F.col(stamp) != F.col("__seen"))).drop("__seen")


def change_classes(segments: DataFrame, links: DataFrame, polygons: DataFrame) -> DataFrame:
    """(station_id, change): each input lists changed stations; a station counts for its heaviest class only."""
    tag = lambda df, n: df.select("station_id", F.lit(n).alias("n"))
    both = reduce(DataFrame.unionByName, [tag(segments, 0), tag(links, 1), tag(polygons, 2)])
    name = F.element_at(F.array(F.lit("segments"), F.lit("links"), F.lit("polygons")), F.min("n") + 1)
    return both.groupBy("station_id").agg(name.alias("change"))


def strip_reason(reasons, code: str, fallback: str):
    """A list of reasons without one code; the fallback alone if none is left."""
    left = F.array_remove(reasons, code)
    return F.when(F.array_contains(reasons, code) & (F.size(left) == 0), F.array(F.lit(fallback))).otherwise(left)


SEGMENT = f"seg_id:bigint,street:string,norm:string,{NUMBER_LISTS},whole:boolean,amended:boolean"


def apply_amendments(segments: DataFrame, ops: DataFrame) -> DataFrame:
    """segments(station_id, seg_id, street, intervals, singles, whole), ops(station_id, doc, bullet, op, street, old, new) ->
    segments after the operations, in the order of (doc, bullet), and whether each was amended.

    Ordered and mutating, so it folds over each station's operations. An operation means the first segment whose street key
    equals, holds or is held in the operation's. 'fix_street_name' renames it; 'replace_range' takes the old numbers out
    (repeats and all) and puts the new ones in; 'add_house' puts the new ones in. The last two make a new segment, numbered
    after the station's largest, where there is none. Other operations change nothing.
    """
    key = lambda c: normalize_street(F.col(c))
    seg = F.struct("seg_id", "street", key("street").alias("norm"), "intervals", "singles", "whole", F.lit(False).alias("amended")).cast(f"struct<{SEGMENT}>")
    rows = segments.groupBy("station_id").agg(F.array_sort(F.collect_list(seg)).alias("segs"))
    asked = ops.withColumns({"old_n": number_lists(F.col("old")), "new_n": number_lists(F.col("new"))})
    op = F.struct("doc", "bullet", "op", "street", "new", key("street").alias("norm"), key("old").alias("old_norm"), key("new").alias("new_norm"), "old_n", "new_n")
    todo = asked.groupBy("station_id").agg(F.array_sort(F.collect_list(op)).alias("ops"))
    empty = F.array().cast(f"array<struct<{SEGMENT}>>")
    met = rows.join(todo, "station_id", "full_outer").select("station_id", F.coalesce("segs", empty).alias("segs"), F.coalesce("ops", F.array().cast(todo.schema["ops"].dataType)).alias("ops"))

    def step(segs: Column, o: Column) -> Column:
        name = F.when(o["op"] == "fix_street_name", o["old_norm"]).otherwise(o["norm"])
        fits = F.transform(segs, lambda s: (s["norm"] != "") & (name != "") & (s["norm"].contains(name) | name.contains(s["norm"])))
        at, numbers = F.array_position(fits, True), o["op"].isin("replace_range", "add_house")
        rest = lambda s, c: F.when(o["op"] == "replace_range", without_values(s[c], o["old_n"][c])).otherwise(s[c])
        renamed = lambda s: F.struct(s["seg_id"], o["new"], o["new_norm"], s["intervals"], s["singles"], s["whole"], F.lit(True))
        filled = lambda s: F.struct(
            s["seg_id"], s["street"], s["norm"], F.concat(rest(s, "intervals"), o["new_n"]["intervals"]), F.concat(rest(s, "singles"), o["new_n"]["singles"]), F.lit(False), F.lit(True)
        )
        one = f"struct<{SEGMENT}>"
        changed = F.transform(segs, lambda s, i: F.when(i + 1 != at, s).when(numbers, filled(s).cast(one)).otherwise(renamed(s).cast(one)))
        number = F.coalesce(F.array_max(F.transform(segs, lambda s: s["seg_id"])), F.lit(0)) + 1
        fresh = F.struct(number, o["street"], o["norm"], o["new_n"]["intervals"], o["new_n"]["singles"], F.lit(False), F.lit(True)).cast(one)
        known = numbers | (o["op"] == "fix_street_name")
        return F.when((at > 0) & known, changed).when(numbers, F.concat(segs, F.array(fresh))).otherwise(segs).cast(f"array<{one}>")

    out = met.select("station_id", F.explode(F.aggregate("ops", F.col("segs"), step)).alias("s"))
    return out.select("station_id", "s.seg_id", "s.street", "s.intervals", "s.singles", "s.whole", "s.amended")


def replace_stations(stations: DataFrame, segments: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole-station replacements, changes(station_id, ordinal, name, address, coverage): the last one of a station stands.

    Gives the stations(station_id, name, address, raw_coverage_text, ...) with its values, and the segments(station_id,
    seg_id, ...) with those of replaced stations left out and read anew from the new texts.
    """
    last = last_write(changes, "station_id", ["ordinal"])
    new = last.select("station_id", *[F.col(c).alias(f"__{c}") for c in ("name", "address", "coverage")])
    patched = stations.join(new, "station_id", "left").withColumns(
        {"name": F.coalesce("__name", "name"), "address": F.coalesce("__address", "address"), "raw_coverage_text": F.coalesce("__coverage", "raw_coverage_text")}
    ).select(*stations.columns)
    again = explode_segments(last.select("station_id", F.col("coverage").alias("raw_coverage_text")))
    kept = segments.join(last.select("station_id"), "station_id", "left_anti")
    return patched, kept.unionByName(again.select(*[c for c in again.columns if c in segments.columns]), allowMissingColumns=True)


def purge_overrides(overrides: DataFrame, segments: DataFrame, texts: DataFrame) -> DataFrame:
    """Overrides(segment_id, ...) without those of stations whose text is overridden: their segments are read anew."""
    gone = segments.join(texts.select("station_id").distinct(), "station_id", "left_semi").select(F.col("id").alias("segment_id"))
    return overrides.join(gone, "segment_id", "left_anti")


def added_claims(additions: DataFrame, streets: DataFrame, base: int = 9_000_000_000_000) -> DataFrame:
    """Reviewers' claims, additions(id, station_id, street_id, manual_json), as resolved segments for ``emit_claims``.

    A street_id of the form sett:<id> claims all streets of that settlement, and yields to street claims. Rows whose JSON
    cannot be read, or whose street or settlement the register does not have, are left out.
    """
    schema = f"struct<{NUMBER_LISTS},whole:boolean,bez_broja:boolean>"
    none = F.lit(None).cast(schema)
    read = additions.withColumn("c", json_or(F.col("manual_json"), schema, none)).where("c IS NOT NULL")
    place = F.when(F.col("street_id").startswith("sett:"), F.substring("street_id", 6, 1 << 20))
    of_place = streets.groupBy(F.col("settlement_id").alias("place")).agg(F.array_sort(F.collect_list(F.col("street_id").cast("string"))).alias("all"))
    of_street = streets.select(F.col("street_id").cast("string").alias("street_id"), F.lit(True).alias("known"))
    met = read.withColumn("place", place).join(of_place, "place", "left").join(of_street, "street_id", "left")
    ids = F.when(F.col("place").isNotNull(), F.col("all")).when(F.col("known"), F.array("street_id"))
    named = met.withColumn("ids", ids).where(F.size("ids") > 0)
    listed = lambda c: F.coalesce(F.col(f"c.{c}"), F.array().cast(named.schema["c"].dataType[c].dataType)).alias(c)
    flag = lambda c: F.coalesce(F.col(f"c.{c}"), F.lit(False)).alias(c)
    return named.select(
        (F.lit(base) + F.col("id")).alias("seg_id"), "station_id", F.get("ids", F.lit(0)).alias("street_id"), F.slice("ids", 2, F.size("ids")).alias("extra"),
        listed("intervals"), listed("singles"), flag("whole"), flag("bez_broja"), F.when(F.col("place").isNotNull(), "sett_whole").otherwise("whole").alias("whole_kind"),
    )
