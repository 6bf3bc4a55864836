"""Proximity resolution: unresolved segments take a street near the station's other coverage, in segment order."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_RADIUS, MAX_RADIUS = 400.0, 3000.0
TIE = 0.1


def anchors(resolved: DataFrame) -> DataFrame:
    """resolved(station_id, x, y) -> (station_id, ax, ay, radius): mean point, and the largest distance to it, clamped.

    The mean is taken before the pass and not moved by it.
    """
    mean = resolved.groupBy("station_id").agg(F.avg("x").alias("ax"), F.avg("y").alias("ay"))
    far = resolved.join(mean, "station_id").groupBy("station_id", "ax", "ay").agg(F.max(F.hypot(F.col("x") - F.col("ax"), F.col("y") - F.col("ay"))).alias("far"))
    spread = F.greatest(F.lit(MIN_RADIUS), F.least(F.lit(MAX_RADIUS), 2 * F.col("far")))
    return far.select("station_id", "ax", "ay", spread.alias("radius"))


def resolve_by_proximity(wanted: DataFrame, candidates: DataFrame) -> DataFrame:
    """wanted(group_rep, seg_id, name_norm, ax, ay, radius), candidates(group_rep, street_id, name_norm, x, y) of streets
    nobody claims yet -> (seg_id, street_id, dist).

    Greedy in segment order: a street is given once. Of same-named candidates within the radius the nearest wins, unless
    the next one is about as near. Sequential per group; candidates meet segments by name, so a group's table is small.
    """
    met = wanted.join(candidates, ["group_rep", "name_norm"]).withColumn("dist", F.hypot(F.col("ax") - F.col("x"), F.col("ay") - F.col("y")))
    near = met.where("dist <= radius").select("group_rep", "seg_id", "street_id", "dist")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for seg, rows in pdf.sort_values(["seg_id", "dist", "street_id"]).groupby("seg_id", sort=True):
            free = rows[~rows.street_id.isin(used)]
            if not len(free):
                continue
            first = free.iloc[0]
            if len(free) > 1 and math.isclose(free.iloc[1].dist, first.dist, rel_tol=TIE, abs_tol=1.0):
                continue
            used.add(first.street_id)
            out.append((seg, first.street_id, first.dist))
        return pd.DataFrame(out, columns=["seg_id", "street_id", "dist"])

    return near.groupBy("group_rep").applyInPandas(choose, "seg_id long, street_id string, dist double")


def marker_scopes(segments: DataFrame, settlements: DataFrame) -> DataFrame:
    """(seg_id, marker): the last segment strictly before in the station whose name is exactly a settlement's."""
    from pyspark.sql import Window

    pool = settlements.select("muni_id", F.col("settlement_norm").alias("name"), "settlement_id").groupBy("muni_id", "name").agg(F.min("settlement_id").alias("place"))
    w = Window.partitionBy("station_id").orderBy("seg_id").rowsBetween(Window.unboundedPreceding, -1)
    met = segments.join(pool, ["muni_id", "name"], "left")
    return met.select("seg_id", F.last("place", ignorenulls=True).over(w).alias("marker"))


def drop_old_names(segments: DataFrame) -> DataFrame:
    """Segments without those whose parenthesised old name restates a street that the station claims plainly."""
    plain = segments.where("NOT parenthesised").select("station_id", "street_id").distinct()
    again = segments.where("parenthesised").join(plain, ["station_id", "street_id"], "left_semi").select("seg_id")
    return segments.join(again, "seg_id", "left_anti")


#: Claims of one segment on one street at most; more raise an error.
MOST_CLAIMS = 100_000


def emit_claims(resolved: DataFrame) -> DataFrame:
    """resolved(seg_id, station_id, street_id, extra, intervals, singles, whole, bez_broja, whole_kind) -> claims, one
    row per street and clause. claim_no follows segments, then clauses as they stand: whole, ranges, numbers, no number."""
    from cadastra.functions.house import suffix_rank

    fields = {"kind": "string", "lo": "bigint", "hi": "bigint", "parity": "string", "lo_sfx": "string", "hi_sfx": "string", "num": "bigint", "num_suffix": "string"}
    blank = {"parity": F.lit("all"), "lo_sfx": F.lit(""), "hi_sfx": F.lit(""), "num_suffix": F.lit("")}
    clause = lambda **given: F.struct(*[(blank | given).get(f, F.lit(None)).cast(t).alias(f) for f, t in fields.items()])
    none = F.array().cast(f"array<struct<{','.join(f'{f}:{t}' for f, t in fields.items())}>>")
    only = lambda test, made: F.when(F.col(test), F.array(made)).otherwise(none)
    clauses = F.concat(
        only("whole", clause(kind=F.col("whole_kind"))),
        F.transform(F.coalesce("intervals", F.array()), lambda i: clause(kind=F.lit("interval"), lo=i["lo"], hi=i["hi"], parity=i["parity"], lo_sfx=i["lo_sfx"], hi_sfx=i["hi_sfx"])),
        F.transform(F.coalesce("singles", F.array()), lambda s: clause(kind=F.lit("single"), num=s["num"], num_suffix=s["suffix"])),
        only("bez_broja", clause(kind=F.lit("bez_broja"))),
    )
    numbered = resolved.where("street_id IS NOT NULL").select("seg_id", "station_id", F.concat(F.array("street_id"), "extra").alias("streets"), F.posexplode(clauses).alias("at", "c"))
    number = F.when(F.col("at") < MOST_CLAIMS, F.col("seg_id") * MOST_CLAIMS + F.col("at")).otherwise(F.raise_error(F.lit("too many clauses in a segment")))
    out = numbered.select("seg_id", "station_id", F.explode(F.array_distinct("streets")).alias("street_id"), number.cast("long").alias("claim_no"), "c.*")
    return out.withColumns({"lo_rank": suffix_rank(F.col("lo_sfx")), "hi_rank": suffix_rank(F.col("hi_sfx"))})
