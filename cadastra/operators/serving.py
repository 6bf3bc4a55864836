"""The serving layer's parameterised queries: lists with nested counts, effective segments, search, settlements, maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP_MEMBERS = "member string, rep string"


def group_rep(muni: Column, reps: dict[str, str]) -> Column:
    """The municipality that stands for a city's parts; others stand for themselves. The map is a fixed, short list."""
    if not reps:
        return muni
    table = F.create_map(*[F.lit(x) for kv in reps.items() for x in kv])
    return F.coalesce(table[muni], muni)


def effective_segments(segments: DataFrame, overrides: DataFrame) -> DataFrame:
    """Segments with reviewers' values over parsed ones: manual coverage and street first, flagged only while unreviewed."""
    o = overrides.select(F.col("segment_id").alias("id"), "manual_json", "manual_street_id", "reviewed")
    met = segments.join(o, "id", "left")
    return met.select(
        *[c for c in segments.columns if c not in ("parsed_json", "street_id", "needs_review")],
        F.coalesce("manual_json", "parsed_json").alias("parsed_json"), F.coalesce("manual_street_id", "street_id").alias("street_id"),
        (F.col("needs_review").cast("boolean") & (F.coalesce("reviewed", F.lit(0)) == 0)).cast("int").alias("needs_review"),
    )


def list_municipalities(munis: DataFrame, stations: DataFrame, segments: DataFrame) -> DataFrame:
    """(id, name_lat, stations, flagged): cities with the sums of their parts, parts not listed on their own.

    segments come from effective_segments. Each side is summed before the join, so nothing fans out.
    """
    flagged = segments.groupBy("station_id").agg(F.sum("needs_review").alias("flagged"))
    per = stations.join(flagged, stations["id"] == flagged["station_id"], "left").groupBy("municipality_id").agg(
        F.count(F.lit(1)).alias("stations"), F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged")
    )
    top = F.coalesce("parent_id", "id")
    sums = munis.join(per, munis["id"] == per["municipality_id"], "left").groupBy(top.alias("id")).agg(
        F.coalesce(F.sum("stations"), F.lit(0)).alias("stations"), F.coalesce(F.sum("flagged"), F.lit(0)).alias("flagged")
    )
    return munis.where("parent_id IS NULL").select("id", "name_lat").join(sums, "id").orderBy(F.collate("name_lat", "sr_Latn"))


def list_stations(stations: DataFrame, segments: DataFrame, muni_id: str) -> DataFrame:
    flagged = segments.groupBy("station_id").agg(F.count(F.lit(1)).alias("segments"), F.sum("needs_review").alias("flagged"))
    mine = stations.where(F.col("municipality_id") == muni_id)
    return mine.join(flagged, mine["id"] == flagged["station_id"], "left").select("id", "number", "name_cyr", F.coalesce("segments", F.lit(0)).alias("segments"), F.coalesce("flagged", F.lit(0)).alias("flagged")).orderBy("number", "id")


def station_segments(segments: DataFrame, streets: DataFrame, settlements: DataFrame, station_id: int) -> DataFrame:
    """A station's segments with the name of what they claim: a street, or a settlement under a prefixed id."""
    names = streets.select(F.col("id").alias("street_id"), F.col("name_cyr").alias("claimed")).unionByName(
        settlements.select(F.concat(F.lit("sett:"), "id").alias("street_id"), F.col("name_cyr").alias("claimed"))
    )
    return segments.where(F.col("station_id") == station_id).join(names, "street_id", "left").orderBy("id")


def assumed_settlements(links: DataFrame, settlements: DataFrame, station_id: int) -> DataFrame:
    """The settlements of a station, its home first."""
    mine = links.where(F.col("station_id") == station_id).join(settlements.select(F.col("id").alias("settlement_id"), "name_lat"), "settlement_id")
    return mine.orderBy((F.col("role") == "home").desc(), "name_lat")


def search_streets(streets: DataFrame, settlements: DataFrame, muni_id: str, query: str) -> DataFrame:
    """(rank, id, name): ten settlements, then thirty streets whose name holds the query; nothing under two letters.

    The query is plain text: wildcards in it have no meaning.
    """
    q = query.strip().upper()
    has = F.upper("name_cyr").contains(q) | F.upper("name_lat").contains(q)
    enough = F.lit(len(q) >= 2)
    mine = settlements.where(F.col("municipality_id") == muni_id)
    places = mine.where(has & enough).select(F.lit(0).alias("rank"), F.concat(F.lit("sett:"), "id").alias("id"), F.col("name_cyr").alias("name"))
    own = streets.join(mine.select(F.col("id").alias("settlement_id")), "settlement_id", "left_semi").where((has | F.col("name_norm").contains(q)) & enough)
    roads = own.select(F.lit(1).alias("rank"), "id", F.col("name_cyr").alias("name"))
    return places.orderBy("name", "id").limit(10).unionByName(roads.orderBy("name", "id").limit(30))


def next_number(stations: DataFrame, added: DataFrame, muni_id: str) -> DataFrame:
    both = stations.select("municipality_id", "number").unionByName(added.select("municipality_id", "number"))
    return both.where(F.col("municipality_id") == muni_id).agg((F.coalesce(F.max("number"), F.lit(0)) + 1).alias("number"))


def neighbours(stations: DataFrame, station_id: int) -> DataFrame:
    """The other stations of the same municipality."""
    me = stations.where(F.col("id") == station_id).select("municipality_id")
    return stations.join(me, "municipality_id", "left_semi").where(F.col("id") != station_id)


def boundaries(shapes: DataFrame, munis: DataFrame, muni_id: str) -> DataFrame:
    """The boundary of a municipality, or those of its parts."""
    mine = munis.where(F.coalesce("parent_id", "id") == muni_id).select(F.col("id").alias("municipality_id"))
    return shapes.join(mine, "municipality_id", "left_semi")


def alive(rows: DataFrame, removed: DataFrame) -> DataFrame:
    return rows.join(removed.select("station_id"), "station_id", "left_anti")


def dirty_scope(dirty: DataFrame, stations: DataFrame, added: DataFrame, reps: dict[str, str]) -> DataFrame:
    """Distinct group representatives of the municipalities with dirty stations, pristine or added."""
    all_stations = stations.select("id", "municipality_id").unionByName(added.select("id", "municipality_id"))
    hit = all_stations.join(dirty.select(F.col("station_id").alias("id")), "id", "left_semi")
    return hit.select(group_rep(F.col("municipality_id"), reps).alias("group_rep")).distinct()


def editor_payload(rows: DataFrame) -> DataFrame:
    """rows(lo_text, hi_text) of an editor -> typed intervals: '12а' splits, an empty upper end is open, zeros go."""
    from cadastra.functions.house import OPEN_END, interval_parity
    from cadastra.functions.text import split_house

    (lo, a), (hi, b) = split_house(F.col("lo_text")), split_house(F.col("hi_text"))
    typed = rows.withColumns({"lo": F.coalesce(lo, F.lit(0)), "lo_sfx": a, "hi": F.when(F.trim("hi_text") == "", F.lit(OPEN_END)).otherwise(F.coalesce(hi, F.lit(0))), "hi_sfx": F.coalesce(b, F.lit(""))})
    kept = typed.where("NOT (lo = 0 AND hi = 0)")
    open_end = F.col("hi") == OPEN_END
    return kept.withColumn("parity", F.when(open_end, interval_parity(F.col("lo"), F.col("lo"))).otherwise(interval_parity(F.col("lo"), F.col("hi"))))
