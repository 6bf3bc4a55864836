"""Arbitration of overlapping claims on the houses of a street.

Claims are joined in two branches, each with an equality key: unbounded kinds on the street, numbers and ranges on street
and number bucket. A house then goes to the one station that holds the most specific claims on it; a tie between stations
is a conflict and links nobody. Both are told by aggregates over (house, specificity), which combine before the shuffle.

Settlement-wide claims can meet thousands of houses on one street: the joins stay hash partitioned and adaptive skew
splitting applies, since no branch is a nested loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions.house import bounds_ok, parity_ok
from cadastra.scratch import written

#: Specificity of each way to claim a house; the highest wins.
EXACT_SINGLE, IMPLIED_SINGLE, INTERVAL, NO_NUMBER, IMPLIED_EDGE, WHOLE, SETTLEMENT = 3.0, 2.0, 1.0, 1.0, 0.5, 0.0, -1.0
BUCKET = 32
#: Houses that one task groups.
HOUSES_AT_ONCE = 500_000

HOUSE = ("address_id", "street_id", "house_num", "suffix", "rank")


def _buckets(claims: DataFrame, houses: DataFrame) -> DataFrame:
    """One row per number bucket that a claim from lo to hi reaches, up to the largest number of its own street."""
    tops = houses.where("house_num IS NOT NULL").groupBy("street_id").agg(F.max("house_num").alias("top"))
    last, first = F.floor(F.least("hi", "top") / BUCKET), F.floor(F.col("lo") / BUCKET)
    return claims.join(tops, "street_id").where(last >= first).withColumn("bucket", F.explode(F.sequence(first, last))).drop("top")


WHO = ("address_id", "claim_no", "seg_id", "station_id")
#: Kinds that claim all houses of a street, or all without a number, whatever the number says; the most specific first.
WIDE = {"bez_broja": NO_NUMBER, "whole": WHOLE, "sett_whole": SETTLEMENT}


def claim_matches(houses: DataFrame, claims: DataFrame) -> DataFrame:
    """houses(address_id, street_id, house_num, suffix, rank) and claims(street_id, claim_no, seg_id, station_id, kind,
    lo, hi, parity, lo_rank, hi_rank, num, num_suffix) -> (address_id, claim_no, seg_id, station_id, spec).

    A null house number takes part in whole, settlement and no-number claims only.
    """
    kind, num = F.col("kind"), F.col("house_num")
    broad = houses.select("street_id", "address_id", "house_num").join(_wide(claims), "street_id").where((kind != "bez_broja") | num.isNull())
    broad = broad.select(*WHO, F.when(kind == "whole", WHOLE).when(kind == "sett_whole", SETTLEMENT).otherwise(NO_NUMBER).alias("spec"))
    return broad.unionByName(_numbered_matches(houses, claims).drop("street_id"))


def _wide(claims: DataFrame) -> DataFrame:
    return claims.where(F.col("kind").isin(*WIDE)).select("street_id", "kind", *WHO[1:])


def _numbered_matches(houses: DataFrame, claims: DataFrame) -> DataFrame:
    """(address_id, claim_no, seg_id, station_id, spec, street_id) of single numbers and intervals, and the houses in them."""
    kind, num, suffix = F.col("kind"), F.col("house_num"), F.col("suffix")
    one = kind == "single"
    narrow = claims.where(kind.isin("single", "interval")).withColumns({"lo": F.when(one, F.col("num")).otherwise(F.col("lo")), "hi": F.when(one, F.col("num")).otherwise(F.col("hi"))})
    numbered = houses.where(num.isNotNull())
    met = numbered.withColumn("bucket", F.floor(num / BUCKET)).join(_buckets(narrow, numbered), ["street_id", "bucket"])
    same, bare = F.col("num_suffix") == suffix, F.col("num_suffix") == ""
    spanned = parity_ok(num, F.col("parity")) & bounds_ok(num, F.col("rank"), F.col("lo"), F.col("hi"), F.col("lo_rank"), F.col("hi_rank"))
    met = met.where(num.between(F.col("lo"), F.col("hi")) & F.when(one, same | bare).otherwise(spanned))
    pinned = ((num == F.col("lo")) & (F.size("lo_rank") > 0)) | ((num == F.col("hi")) & (F.size("hi_rank") > 0))
    spec = F.when(one, F.when(same, EXACT_SINGLE).otherwise(IMPLIED_SINGLE)).when((suffix != "") & ~pinned, IMPLIED_EDGE).otherwise(INTERVAL)
    return met.select(*WHO, spec.alias("spec"), "street_id")


HELD = ("least", "most", "seg_id", "claim_no")


def _held(matches: DataFrame, *keys: str) -> DataFrame:
    """The least and the largest station of each group of claims, and its lowest claim."""
    return matches.groupBy(*keys).agg(
        F.min("station_id").alias("least"), F.max("station_id").alias("most"), F.min_by("seg_id", "claim_no").alias("seg_id"), F.min("claim_no").alias("claim_no")
    )


def _highest(levels: DataFrame) -> DataFrame:
    return levels.groupBy("address_id").agg(F.max("spec").alias("spec"), *[F.max_by(c, "spec").alias(c) for c in HELD])


def top_claims(matches: DataFrame) -> DataFrame:
    """(address_id, spec, least, most, seg_id, claim_no): each house's highest specificity, the least and the largest
    station that has it, and the lowest claim with it."""
    return _highest(_held(matches, "address_id", "spec"))


def _tasks(houses: DataFrame) -> int:
    return max(houses.sparkSession.sparkContext.defaultParallelism, houses.count() // HOUSES_AT_ONCE + 1)


def _top_of_houses(houses: DataFrame, claims: DataFrame, *more: str) -> DataFrame:
    """top_claims of claim_matches, with a street's wide claims held together before they meet its houses, one row each.

    A wide kind and a claim on a number never have the same specificity on one house. more: wide (the kind's place in WIDE,
    or null), street_id. Matches are dealt by house before they are grouped, to as many tasks as there are houses for: they
    are nearly distinct, so grouping them where they are made would hold them all for nothing.
    """
    held = _held(_wide(claims), "street_id", "kind").withColumn("held", F.struct(*HELD))
    streets = held.groupBy("street_id").agg(*[F.max(F.when(F.col("kind") == k, F.col("held"))).alias(k) for k in WIDE])
    broad = houses.select("address_id", "street_id", F.col("house_num").isNull().alias("bare")).join(streets, "street_id", "left")
    has = {k: F.col(k).isNotNull() & (F.col("bare") if k == "bez_broja" else F.lit(True)) for k in WIDE}
    pick = lambda of: F.coalesce(*[F.when(has[k], of(k)) for k in WIDE])
    broad = broad.select(
        "address_id", "street_id", pick(lambda k: F.lit(WIDE[k])).alias("spec"), pick(lambda k: F.lit(list(WIDE).index(k))).alias("wide"), pick(F.col).alias("held")
    )
    tasks, values = _tasks(houses), ("spec", *HELD, *(c for c in more if c != "street_id"))
    broad = broad.select("address_id", *[c for c in more if c == "street_id"], "spec", *[F.col(f"held.{c}").alias(c) for c in HELD], *[c for c in more if c == "wide"])
    matches = _numbered_matches(houses, claims).drop("street_id").repartition(tasks, "address_id")
    narrow = _highest(_held(matches, "address_id", "spec")).withColumn("wide", F.lit(None).cast("int"))
    narrow = narrow.select("address_id", *[F.col(c).alias(f"{c}_2") for c in values])
    met = broad.repartition(tasks, "address_id").join(narrow, "address_id", "left")
    higher = F.col("spec_2") > F.coalesce("spec", F.lit(float("-inf")))
    best = [F.when(higher, F.col(f"{c}_2")).otherwise(F.col(c)).alias(c) for c in values]
    return met.select("address_id", *[c for c in more if c == "street_id"], *best).where("spec IS NOT NULL")


def _links(top: DataFrame) -> DataFrame:
    return top.where("least = most").select("address_id", F.col("least").alias("station_id"), "seg_id", "claim_no", "spec")


def arbitrate(matches: DataFrame) -> DataFrame:
    """(address_id, station_id, seg_id, claim_no, spec): the winner of each house that has one; lowest claim_no of it."""
    return _links(top_claims(matches))


def arbitrate_houses(houses: DataFrame, claims: DataFrame) -> DataFrame:
    """arbitrate of claim_matches, without a row for each house and wide claim."""
    return _links(_top_of_houses(houses, claims))


def _rivals(tied: DataFrame, *keys: str) -> DataFrame:
    """tied(keys, seg_id, station_id), distinct -> distinct (seg_id, station_id, rivals): all stations of its groups."""
    rivals = tied.groupBy(*keys).agg(F.array_sort(F.collect_set("station_id")).alias("rivals"))
    return tied.join(rivals, list(keys)).select("seg_id", "station_id", "rivals").distinct()


def _opponents(met: DataFrame) -> DataFrame:
    others = met.select("seg_id", F.explode(F.array_except("rivals", F.array("station_id"))).alias("station_id")).distinct()
    return others.groupBy("seg_id").agg(F.array_sort(F.collect_list("station_id")).alias("opponents"))


def conflicts(matches: DataFrame) -> DataFrame:
    """(seg_id, opponents): the other stations that tie with a segment on some house, in order.

    Houses with the same stations tie are one row per segment before pairs are made.
    """
    ties = top_claims(matches).where("least < most").select("address_id", "spec")
    tied = matches.join(ties, ["address_id", "spec"]).select("address_id", "seg_id", "station_id").distinct()
    return _opponents(_rivals(tied, "address_id"))


def house_conflicts(houses: DataFrame, claims: DataFrame) -> DataFrame:
    """conflicts of claim_matches: wide claims tie once on a street, whatever the number of its houses they tie on."""
    ties = written(_top_of_houses(houses, claims, "wide", "street_id").where("least < most").select("address_id", "spec", "wide", "street_id"), "ties")
    numbered = _numbered_matches(houses, claims).join(ties.where("wide IS NULL").select("address_id", "spec"), ["address_id", "spec"])
    numbered = numbered.select("address_id", "seg_id", "station_id").distinct()
    kind = F.element_at(F.array(*map(F.lit, WIDE)), F.col("wide") + 1)
    streets = ties.where("wide IS NOT NULL").select("street_id", kind.alias("kind")).distinct()
    wide = _wide(claims).join(streets, ["street_id", "kind"]).select("street_id", "kind", "seg_id", "station_id").distinct()
    return _opponents(_rivals(numbered, "address_id").unionByName(_rivals(wide, "street_id", "kind")))


def parity_unconfirmed(houses: DataFrame, claims: DataFrame, links: DataFrame) -> DataFrame:
    """(seg_id) of one-sided intervals whose other side has houses of which no other station holds any."""
    sided = claims.where("kind = 'interval' AND parity <> 'all'")
    spread = _buckets(sided, houses)
    held = links.select("address_id", F.col("station_id").alias("holder"))
    numbered = houses.where("house_num IS NOT NULL").withColumn("bucket", F.floor(F.col("house_num") / BUCKET))
    num = F.col("house_num")
    met = numbered.join(spread, ["street_id", "bucket"]).where(
        num.between(F.col("lo"), F.col("hi")) & ((num % 2 == 0) == (F.col("parity") == "odd"))
    )
    per_claim = met.join(held, "address_id", "left").groupBy("street_id", "claim_no", "seg_id").agg(
        F.bool_or(F.coalesce(F.col("holder") != F.col("station_id"), F.lit(False))).alias("confirmed")
    )
    return per_claim.where("NOT confirmed").select("seg_id").distinct()


def station_points(houses: DataFrame, claims: DataFrame) -> DataFrame:
    """(station_id, address_id, seg_id): every house a station claims, without arbitration; its first segment stands."""
    return claim_matches(houses, claims).groupBy("station_id", "address_id").agg(F.min("seg_id").alias("seg_id"))


def station_sums(houses: DataFrame, claims: DataFrame) -> DataFrame:
    """(station_id, points, seg_sum): number of the rows of station_points and sum of their segments, by station.

    A wide claim counts the houses of its street at once; claims on numbers add what a station's wide ones do not have.
    """
    wide = _wide(claims).groupBy("street_id", "station_id").agg(F.min(F.when(F.col("kind") != "bez_broja", F.col("seg_id"))).alias("all"), F.min("seg_id").alias("bare"))
    size = houses.groupBy("street_id").agg(F.count("house_num").alias("numbered"), F.count_if(F.col("house_num").isNull()).alias("others"))
    some = F.col("all").isNotNull()
    met = wide.join(size, "street_id")
    met = met.select("station_id", (F.when(some, F.col("numbered")).otherwise(0) + F.col("others")).alias("points"), (F.when(some, F.col("numbered") * F.col("all")).otherwise(0) + F.col("others") * F.col("bare")).alias("seg_sum"))
    own = _numbered_matches(houses, claims).repartition(_tasks(houses), "address_id").groupBy("street_id", "address_id", "station_id").agg(F.min("seg_id").alias("seg_id"))
    more = own.join(wide.where(some).select("street_id", "station_id", "all"), ["street_id", "station_id"], "left")
    more = more.select("station_id", F.when(some, 0).otherwise(1).cast("long").alias("points"), (F.when(some, F.least("seg_id", "all") - F.col("all")).otherwise(F.col("seg_id"))).alias("seg_sum"))
    sums = met.unionByName(more).groupBy("station_id").agg(F.sum("points").alias("points"), F.sum("seg_sum").alias("seg_sum"))
    return sums.where("points > 0")
