"""Resolution of names to register entities by an ordered ladder of rungs.

Every rung gives candidates with its place in the ladder, and one aggregation keeps each segment's first. The rungs fall
into three groups: keys (equi joins only), a settlement's name in front of the street's, and scores with what follows
them. Only what a group leaves open is written and goes on, so the plan grows with the number of rungs, not with its
powers, and a name that a key settles never meets a score.

Alternate keys of the register (declined, reordered, without the word for street) are a table; the first street in
register order wins a key, a street's own name before all others.

Methods and scores: exact and alias 100, base_parts 90, fuzzy 88 or its score, settlement 85, locality 80, abbrev 70,
muni_fallback 100, ambiguous and none 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.similarity import weighted_ratio_udf
from cadastra.functions.text import digit_guard, edit_keys, genitive_variants, normalize_street, one_edit, sort_key
from cadastra.scratch import written

FUZZY_SETTLEMENT, FUZZY_MUNICIPALITY, FUZZY_PLACE = 90.0, 93.0, 90.0
# Words that begin streets without naming a locality, words of a settlement claim, a spelled-out title.
NO_LOCALITY = "ЗАСЕЛАК НАСЕЉЕ НАСЕЉЕНО САЛАШ ПОТЕС МАХАЛА ПУТ БЛОК ТРГ КРАЈ СОКАК УЛИЦА ДЕО НОВА СТАРА".split()
HAMLET, STREET_WORD, FIRST_PART = "ЗАСЕЛАК", "УЛИЦА", " 1 ДЕО"
PLACE_WORDS = r"^(НАСЕЉЕНО МЕСТО|НАСЕЉЕ) "
TITLES = {"ПРОФ": "ПРОФЕСОРА"}
#: Methods that a station's coverage of a settlement can be told by, and those that stay within the settlement asked.
EVIDENCE = ("exact", "alias", "muni_fallback", "base_parts", "locality", "settlement")
CLEAN = ("exact", "alias", "base_parts", "locality")

IDS = "array<string>"
# Places in the ladder.
NAME, ALTERNATE, DECLINED, REORDERED, PART_ONE, NO_STREET_WORD, PARTS, LOCALITY, PREFIX, FUZZY, SUBSET, ABBREVIATION, MUNICIPALITY, MUNICIPALITY_FUZZY, PLACE = (100 * n for n in range(15))


def _words(c: Column | str) -> Column:
    return F.split(c, " ")


def _without_street_word(c: Column) -> Column:
    """The name without the word for street, or null where nothing changes."""
    rest = F.array_join(F.array_remove(_words(c), STREET_WORD), " ")
    return F.when((rest != c) & (rest != ""), rest)


def names_of(raw: Column) -> tuple[Column, Column]:
    """(name, alternate) of a street as written: what stands in parentheses is another name and never scored."""
    inner, outer = F.regexp_extract(raw, r"\(([^)]*)\)", 1), normalize_street(F.regexp_replace(raw, r"\([^)]*\)", " "))
    return F.when(outer == "", normalize_street(raw)).otherwise(outer), F.when(inner == "", "").otherwise(normalize_street(inner))


def with_aliases(segments: DataFrame, aliases: DataFrame) -> DataFrame:
    """segments(muni_id, name, ...), aliases(muni_id, name, register_name) -> names of the register, and whether aliased."""
    met = segments.join(aliases.select("muni_id", "name", F.col("register_name").alias("__to")), ["muni_id", "name"], "left")
    out = met.withColumn("aliased", F.col("__to").isNotNull()).withColumn("name", F.coalesce("__to", "name"))
    return out.select(*segments.columns, "aliased")


def register_keys(streets: DataFrame) -> DataFrame:
    """streets(street_id, settlement_id, name_norm, ordinal) -> (settlement_id, key, street_id), one street a key."""
    name = F.col("name_norm")
    declined = F.transform(genitive_variants(name), lambda v, i: F.struct(F.lit(1).alias("kind"), i.alias("rank"), v.alias("key")))
    ordered = F.transform(
        F.concat(F.array(name), genitive_variants(name)), lambda v, i: F.struct(F.lit(2).alias("kind"), i.alias("rank"), sort_key(v).alias("key"))
    )
    own = F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).alias("rank"), name.alias("key")))
    bare = F.array(F.struct(F.lit(3).alias("kind"), F.lit(0).alias("rank"), _without_street_word(name).alias("key")))
    forms = streets.select("settlement_id", "street_id", "ordinal", F.explode(F.concat(own, declined, ordered, bare)).alias("f"))
    kept = forms.where(F.col("f.key").isNotNull() & (F.col("f.key") != ""))
    first = kept.groupBy("settlement_id", F.col("f.key").alias("key")).agg(
        F.min_by("street_id", F.struct("f.kind", "f.rank", "ordinal", "street_id")).alias("street_id")
    )
    return first


def _candidate(df: DataFrame, rung: Column | int, method: Column | str, score: Column | float, ids: Column | None = None) -> DataFrame:
    """Candidates (seg_id, rung, street_id, method, score, extra); with ids, the first is the street, the rest go along."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    street = F.col("street_id").cast("string") if ids is None else F.get(ids, F.lit(0))
    extra = F.array().cast(IDS) if ids is None else F.slice(ids, 2, F.greatest(F.size(ids), F.lit(1)))
    return df.select(
        "seg_id", lit(rung).cast("int").alias("rung"), street.alias("street_id"), lit(method).alias("method"), lit(score).cast("double").alias("score"), extra.alias("extra")
    )


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _lowest(candidates: DataFrame) -> DataFrame:
    """The candidate of the lowest rung of each segment."""
    value = F.struct("street_id", "method", "score", "extra")
    best = candidates.groupBy("seg_id").agg(F.min_by(value, F.struct("rung", F.col("score") * -1, "street_id")).alias("v"))
    return best.select("seg_id", "v.*")


def _only(df: DataFrame) -> DataFrame:
    """Rows of segments with exactly one distinct street."""
    one = df.groupBy("seg_id").agg(F.count_distinct("street_id").alias("n"), F.min("street_id").alias("street_id"))
    return one.where("n = 1").select("seg_id", "street_id")


def _own() -> Column:
    return F.when(F.col("aliased"), "alias").otherwise("exact")


def _ids(df: DataFrame, *order: str) -> DataFrame:
    """(seg_id, ids): the distinct streets of each segment, in the order of the given columns."""
    met = df.groupBy("seg_id").agg(F.array_sort(F.collect_set(F.struct(*order, F.col("street_id").cast("string").alias("street_id")))).alias("all"))
    return met.select("seg_id", F.array_distinct(F.transform("all", lambda x: x["street_id"])).alias("ids"))


def _by_keys(left: DataFrame, streets: DataFrame, keys: DataFrame) -> DataFrame:
    """Candidates by a name's own forms in the settlement, or by a form that only one street of the municipality has."""
    name, variants = F.col("name"), genitive_variants(F.col("name"))
    form = lambda rung, key: F.struct(rung.cast("int").alias("rung"), key.alias("key"))
    part = F.when(name.endswith(FIRST_PART), F.left(name, F.length(name) - len(FIRST_PART)))
    forms = F.concat(
        F.array(form(F.lit(NAME), name), form(F.lit(ALTERNATE), F.when(F.col("alt") != "", F.col("alt")))),
        F.transform(variants, lambda v, i: form(i + DECLINED, v)),
        F.transform(F.concat(F.array(name), variants), lambda v, i: form(i + REORDERED, sort_key(v))),
        F.array(form(F.lit(PART_ONE), part), form(F.lit(NO_STREET_WORD), _without_street_word(name))),
    )
    tries = left.select("seg_id", "muni_id", "settlement_id", "aliased", F.explode(forms).alias("f"))
    tries = tries.select("seg_id", "muni_id", "settlement_id", "aliased", "f.rung", "f.key").where("key IS NOT NULL")
    method = F.when(F.col("rung") == ALTERNATE, "exact").otherwise(_own())
    here = _candidate(tries.join(keys, ["settlement_id", "key"]), F.col("rung"), method, 100.0)
    unique = streets.groupBy("muni_id", F.col("name_norm").alias("key")).agg(F.count_distinct("street_id").alias("n"), F.min("street_id").alias("street_id"))
    wider = tries.where(F.col("rung").isin(PART_ONE, NO_STREET_WORD)).join(unique.where("n = 1"), ["muni_id", "key"])
    return here.unionByName(_candidate(wider, F.col("rung") + 1, F.when(F.col("settlement_id").isNotNull(), "muni_fallback").otherwise(_own()), 100.0))


def _by_parts(left: DataFrame, streets: DataFrame) -> DataFrame:
    """A base name claims its numbered parts: those of the settlement, or else of the municipality."""
    tail = F.regexp_extract("name_norm", r"((?: (?:\d+|ДЕО))+)$", 1)
    cut = streets.withColumn("tail", tail).where("tail <> ''").withColumn("more", F.explode(F.sequence(F.lit(1), F.size(_words("tail")) - 1)))
    size = F.size(_words("name_norm")) - F.col("more")
    parts = cut.where(size > 0).select("muni_id", "settlement_id", "ordinal", "street_id", F.array_join(F.slice(_words("name_norm"), F.lit(1), size), " ").alias("name"))
    asked = left.select("seg_id", "muni_id", "settlement_id", "name")
    here = _ids(asked.join(parts.drop("muni_id"), ["settlement_id", "name"]), "ordinal")
    there = _ids(asked.drop("settlement_id").join(parts.drop("settlement_id"), ["muni_id", "name"]), "ordinal")
    return _candidate(here, PARTS, "base_parts", 90.0, F.col("ids")).unionByName(_candidate(there, PARTS + 1, "base_parts", 90.0, F.col("ids")))


def _by_locality(left: DataFrame, streets: DataFrame) -> DataFrame:
    """A single word that begins two streets or more of the settlement (behind the word for hamlet, too) claims them."""
    w = _words("name_norm")
    behind = (F.get(w, F.lit(0)) == HAMLET) & (F.size(w) > 2)
    named = streets.select("settlement_id", "street_id", "ordinal", F.explode(F.array(F.lit(1), F.when(behind, 2))).alias("at"), w.alias("w")).where("at IS NOT NULL")
    rest = F.slice("w", F.col("at") + 1, F.size("w"))
    named = named.where((F.size(rest) > 0) & ~F.forall(rest, lambda x: x.rlike(r"^(\d+|ДЕО)$")))
    heads = named.select("settlement_id", F.get("w", F.col("at") - 1).alias("name"), "ordinal", "street_id")
    asked = left.where(~F.col("name").contains(" ") & ~F.col("name").rlike(r"^\d*$") & ~F.col("name").isin(*NO_LOCALITY))
    met = _ids(asked.select("seg_id", "settlement_id", "name").join(heads, ["settlement_id", "name"]), "ordinal").where(F.size("ids") >= 2)
    return _candidate(met, LOCALITY, "locality", 80.0, F.col("ids"))


def can_reach(a: Column, b: Column, threshold: float) -> Column:
    """False only where the weighted ratio of two names stays below threshold (90 or more).

    The plain and the sorted ratio ask for few insertions and deletions, which bound the Levenshtein distance; the ratio of
    shared words asks for what is left beside them to be short on one side or alike; the best part, weighted, is reached
    only by a name within the other.
    """
    la, lb = F.length(a), F.length(b)
    total, share = la + lb, (100.0 - threshold) / 100
    loose = (100.0 - threshold / 0.95) / 100
    wa, wb = F.array_distinct(_words(a)), F.array_distinct(_words(b))
    only_a, only_b = (F.array_join(F.array_sort(F.array_except(x, y)), " ") for x, y in ((wa, wb), (wb, wa)))
    left, right = F.length(only_a), F.length(only_b)
    shared = F.greatest(la, lb) + 1
    words = F.arrays_overlap(wa, wb) & (
        (F.least(left, right) <= 2 * loose / (1 - loose) * shared + 1) | ((F.abs(left - right) <= loose * (total + 2)) & (F.levenshtein(only_a, only_b) <= loose * (total + 2)))
    )
    near = (F.abs(la - lb) <= share * total) & ((F.levenshtein(a, b) <= share * total) | (F.levenshtein(sort_key(a), sort_key(b)) <= loose * total))
    alike = F.greatest(la, lb) < 1.5 * F.least(la, lb)
    part = F.lit(threshold <= 90.0) & (a.contains(b) | b.contains(a) | sort_key(a).contains(sort_key(b)) | sort_key(b).contains(sort_key(a)))
    return F.when(alike, near | words).otherwise(part | near)


def _scored(left: DataFrame, streets: DataFrame, scope: str, threshold: float) -> DataFrame:
    """Pairs of a scope that reach the threshold; a pair that cannot is left out before it is scored."""
    pool = streets.select(scope, "street_id", "name_norm", "ordinal")
    met = left.join(pool, scope).where(can_reach(F.col("name"), F.col("name_norm"), threshold))
    return met.withColumn("s", weighted_ratio_udf("name", "name_norm")).where(F.col("s") >= threshold)


def _by_score(left: DataFrame, streets: DataFrame) -> DataFrame:
    """The best score of the settlement, if the numbers of both names agree: the best one only is looked at."""
    scored = _scored(left.select("seg_id", "settlement_id", "name"), streets, "settlement_id", FUZZY_SETTLEMENT)
    best = scored.groupBy("seg_id", "name").agg(F.min_by(F.struct("street_id", "name_norm", "s"), F.struct(-F.col("s"), "ordinal", "street_id")).alias("b"))
    good = best.where(digit_guard(F.col("name"), F.col("b.name_norm"))).select("seg_id", "b.street_id", "b.s")
    return _candidate(good, FUZZY, "fuzzy", F.col("s"))


def _by_subset(left: DataFrame, streets: DataFrame) -> DataFrame:
    """All words of the name within a longer street name of the same last word, the least number of others, and unique."""
    named = streets.withColumn("last", F.element_at(_words("name_norm"), -1)).select("settlement_id", "last", "street_id", "name_norm")
    asked = left.where(F.col("name").contains(" ")).select("seg_id", "settlement_id", "name", F.element_at(_words("name"), -1).alias("last"))
    met = asked.join(named, ["settlement_id", "last"])
    met = met.where((F.size(F.array_except(_words("name"), _words("name_norm"))) == 0) & (F.size(_words("name_norm")) > F.size(_words("name"))))
    met = met.withColumn("more", F.size(F.array_except(_words("name_norm"), _words("name"))))
    least = met.groupBy("seg_id", "more").agg(F.count_distinct("street_id").alias("n"), F.min("street_id").alias("street_id"))
    first = least.groupBy("seg_id").agg(F.min_by(F.struct("n", "street_id"), "more").alias("b")).where("b.n = 1").select("seg_id", "b.street_id")
    return _candidate(first, SUBSET, "fuzzy", 88.0)


def _by_abbreviation(left: DataFrame, streets: DataFrame) -> DataFrame:
    """The same number of words, each equal, its initial, or a title and its long form; one at least shortened; unique."""
    reg = streets.withColumn("n", F.size(_words("name_norm"))).select("settlement_id", "n", "street_id", "name_norm")
    asked = left.where(F.col("name").contains(" ")).select("seg_id", "settlement_id", "name", F.size(_words("name")).alias("n"))
    initial = lambda a, b: (F.length(a) == 1) & a.rlike(r"^\p{L}$") & b.startswith(a)
    titled = lambda a, b: F.lit(False) if not TITLES else reduce(Column.__or__, [((a == s) & (b == x)) | ((a == x) & (b == s)) for s, x in TITLES.items()])
    met = asked.join(reg, ["settlement_id", "n"]).where(F.col("name") != F.col("name_norm"))
    fits = F.forall(F.zip_with(_words("name"), _words("name_norm"), lambda a, b: (a == b) | initial(a, b) | titled(a, b)), lambda x: x)
    return _candidate(_only(met.where(fits)), ABBREVIATION, "abbrev", 70.0)


def _by_municipality(left: DataFrame, streets: DataFrame) -> DataFrame:
    """The name, or else its alternate, elsewhere in the municipality: one street is a fallback, several are ambiguous."""
    asked = left.select("seg_id", "muni_id", "settlement_id", "aliased", F.posexplode(F.array("name", F.when(F.col("alt") != "", F.col("alt")))).alias("p", "key"))
    pool = streets.select("muni_id", F.col("name_norm").alias("key"), F.col("street_id").cast("string").alias("street_id"))
    met = asked.where("key IS NOT NULL").join(pool, ["muni_id", "key"])
    met = met.groupBy("seg_id", "p", "aliased", F.col("settlement_id").isNull().alias("homeless")).agg(F.array_sort(F.collect_set("street_id")).alias("ids"))
    one = F.size("ids") == 1
    method = F.when(one, F.when(F.col("homeless"), _own()).otherwise("muni_fallback")).otherwise("ambiguous")
    ids = F.when(one, F.col("ids")).otherwise(F.concat(F.array(F.lit(None).cast("string")), F.col("ids")))
    return _candidate(met, F.col("p") + MUNICIPALITY, method, F.when(one, 100.0).otherwise(0.0), ids)


def _by_municipality_score(left: DataFrame, streets: DataFrame) -> DataFrame:
    """Without a home settlement, or with an inferred one: the only name of the municipality over the threshold, if it is
    the name of one street."""
    asked = left.where(F.col("settlement_id").isNull() | F.col("inferred")).select("seg_id", "muni_id", "name")
    scored = _scored(asked, streets, "muni_id", FUZZY_MUNICIPALITY).where(digit_guard(F.col("name"), F.col("name_norm")))
    one = scored.groupBy("seg_id").agg(
        F.count_distinct("name_norm").alias("names"), F.count_distinct("street_id").alias("n"), F.min("street_id").alias("street_id"), F.max("s").alias("s")
    )
    return _candidate(one.where("names = 1 AND n = 1"), MUNICIPALITY_FUZZY, "fuzzy", F.col("s"))


def _by_place(left: DataFrame, streets: DataFrame, settlements: DataFrame) -> DataFrame:
    """A settlement's own name, or with the words for settlement before it, claims all its streets."""
    pool = settlements.select("muni_id", F.col("settlement_norm").alias("key"), F.col("settlement_id").alias("place"))
    asked = left.select("seg_id", "muni_id", F.regexp_replace("name", PLACE_WORDS, "").alias("key"))
    filled = streets.select(F.col("settlement_id").alias("place")).distinct()
    met = asked.join(pool, ["muni_id", "key"]).join(filled, "place", "left_semi").groupBy("seg_id").agg(F.min("place").alias("place"))
    of_place = streets.groupBy(F.col("settlement_id").alias("place")).agg(F.array_sort(F.collect_list(F.struct("ordinal", F.col("street_id").cast("string").alias("street_id")))).alias("all"))
    claimed = met.join(of_place, "place").withColumn("ids", F.transform("all", lambda x: x["street_id"]))
    return _candidate(claimed, PLACE, "settlement", 85.0, F.col("ids"))


def _by_prefix(left: DataFrame, streets: DataFrame, settlements: DataFrame, fuzzy: bool) -> DataFrame:
    """A settlement's name before the street's: the rest is asked for in that settlement; the longest settlement name that
    leads to a street wins."""
    first = lambda c: F.get(_words(c), F.lit(0))
    places = settlements.where("settlement_norm <> ''").select("muni_id", first("settlement_norm").alias("head"), "settlement_norm", F.col("settlement_id").alias("place"))
    asked = left.where(F.col("name").contains(" ")).select("seg_id", "muni_id", "name", "aliased", first("name").alias("head"))
    met = asked.join(places, ["muni_id", "head"]).where(F.col("name").startswith(F.concat("settlement_norm", F.lit(" "))))
    rest = F.substring(F.col("name"), F.length("settlement_norm") + 2, F.length("name"))
    inner = written(met.select(
        F.struct(F.col("seg_id").alias("seg"), (-F.length("settlement_norm")).alias("place"), F.col("place").alias("id")).alias("seg_id"),
        "muni_id", F.col("place").alias("settlement_id"), rest.alias("name"), F.lit("").alias("alt"), "aliased", F.lit(False).alias("inferred"),
    ), "prefixed")
    if not inner.limit(1).count():
        return _candidate(left.where("false").withColumn("street_id", F.lit("")), PREFIX, "none", 0.0)
    found = _ladder(inner, streets, settlements, fuzzy, prefix=False).where("street_id IS NOT NULL")
    best = found.groupBy("seg_id.seg").agg(F.min_by(F.struct("street_id", "method", "score", "extra"), F.struct("seg_id.place", "seg_id.id")).alias("v"))
    return best.select(F.col("seg").alias("seg_id"), F.lit(PREFIX).alias("rung"), "v.*")


def _ladder(segments: DataFrame, streets: DataFrame, settlements: DataFrame, fuzzy: bool, prefix: bool) -> DataFrame:
    keys = register_keys(streets)
    found = [written(_lowest(_all([_by_keys(segments, streets, keys), _by_parts(segments, streets), _by_locality(segments, streets)])), "by-keys")]
    left = written(segments.join(found[0], "seg_id", "left_anti"), "open")
    if prefix:
        found.append(written(_lowest(_by_prefix(left, streets, settlements, fuzzy)), "by-prefix"))
        left = left.join(found[1], "seg_id", "left_anti")
    rungs = [_by_subset(left, streets), _by_abbreviation(left, streets), _by_municipality(left, streets), _by_place(left, streets, settlements)]
    if fuzzy:
        rungs += [_by_score(left, streets), _by_municipality_score(left, streets)]
    found.append(written(_lowest(_all(rungs)), "by-score"))
    settled = _all(found)
    none = left.join(found[-1], "seg_id", "left_anti")
    return settled.unionByName(none.select("seg_id", F.lit(None).cast("string").alias("street_id"), F.lit("none").alias("method"), F.lit(0.0).alias("score"), F.array().cast(IDS).alias("extra")))


def resolve(segments: DataFrame, streets: DataFrame, settlements: DataFrame, fuzzy: bool = True, aliases: DataFrame | None = None) -> DataFrame:
    """segments(seg_id, muni_id, settlement_id or null, name, alt[, inferred]) -> (seg_id, street_id, method, score, extra).

    streets(street_id, settlement_id, muni_id, name_norm, ordinal), settlements(settlement_id, muni_id, settlement_norm),
    aliases(muni_id, name, register_name), one row a name. inferred tells that the settlement is only the municipality's
    town. Every segment comes out once; what no rung settles has method 'none'. Equal questions are asked once.
    """
    asked = segments if "inferred" in segments.columns else segments.withColumn("inferred", F.lit(False))
    asked = asked.select("seg_id", "muni_id", "settlement_id", "name", F.coalesce("alt", F.lit("")).alias("alt"), "inferred")
    asked = with_aliases(asked, aliases) if aliases is not None else asked.withColumn("aliased", F.lit(False))
    asked = written(asked, "asked")
    what = [c for c in asked.columns if c != "seg_id"]
    once = written(asked.select(*what).distinct().withColumn("ask", F.monotonically_increasing_id()), "asked-once")
    register = written(streets.select("street_id", "settlement_id", "muni_id", "name_norm", "ordinal"), "register")
    found = _ladder(once.withColumnRenamed("ask", "seg_id"), register, settlements, fuzzy, prefix=True).withColumnRenamed("seg_id", "ask")
    other = once.withColumnsRenamed({c: f"__{c}" for c in what})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in what])
    return asked.join(other, same).select("seg_id", "ask").join(found, "ask").select("seg_id", "street_id", "method", "score", "extra")


def one_edit_pairs(left: DataFrame, right: DataFrame, scope: str) -> DataFrame:
    """left(scope, x), right(scope, y) -> the distinct (scope, x, y) that are one edit apart at most.

    Names meet under the keys they have in common, each distinct name once, so a scope is never crossed with itself.
    """
    keyed = lambda df, name: df.select(scope, name).distinct().withColumn("__key", F.explode(edit_keys(F.col(name))))
    met = keyed(left, "x").join(keyed(right, "y"), [scope, "__key"]).select(scope, "x", "y").distinct()
    return met.where(one_edit(F.col("x"), F.col("y")))


def superset_counts(sets: DataFrame, scope: str) -> DataFrame:
    """sets(scope, w array of distinct words, c), each set once -> (scope, w, total): c summed over the sets of the scope
    that hold all words of w, its own included.

    A set looks among those that hold its rarest word.
    """
    words = sets.select(scope, "w", "c", F.explode("w").alias("word"))
    often = words.groupBy(scope, "word").agg(F.count(F.lit(1)).alias("often"))
    rarest = words.join(often, [scope, "word"]).groupBy(scope, "w").agg(F.min_by("word", F.struct("often", "word")).alias("word"))
    met = rarest.join(words.select(scope, "word", F.col("w").alias("v"), "c"), [scope, "word"]).where(F.size(F.array_except("w", "v")) == 0)
    return met.groupBy(scope, "w").agg(F.sum("c").alias("total"))


# ---- settlements ----


def resolve_settlement(names: DataFrame, settlements: DataFrame) -> DataFrame:
    """names(seg_id, muni_id, name) -> (seg_id, settlement_id, rung): 0 exact, 1 the best score, 2 one unique edit (six
    letters at least), 3 the only settlement that has all words of the name."""
    pool = settlements.select("muni_id", "settlement_id", "settlement_norm")
    met = names.where("name <> ''").join(pool, "muni_id")
    a, b = F.col("name"), F.col("settlement_norm")
    scored = met.where((a != b) & can_reach(a, b, FUZZY_PLACE)).withColumn("s", weighted_ratio_udf("name", "settlement_norm")).where(F.col("s") >= FUZZY_PLACE)
    edits = one_edit_pairs(names.select("muni_id", F.col("name").alias("x")).where("length(x) >= 6"), pool.select("muni_id", b.alias("y")), "muni_id")
    near = names.withColumnRenamed("name", "x").join(edits, ["muni_id", "x"]).join(pool.withColumnRenamed("settlement_norm", "y"), ["muni_id", "y"])
    one = lambda df, rung: df.groupBy("seg_id").agg(F.count_distinct("settlement_id").alias("n"), F.min("settlement_id").alias("settlement_id")).where("n = 1").select("seg_id", "settlement_id", F.lit(rung).alias("rung"))
    rungs = [
        met.where(a == b).groupBy("seg_id").agg(F.min("settlement_id").alias("settlement_id"), F.lit(0).alias("rung")),
        scored.groupBy("seg_id").agg(F.min_by("settlement_id", F.struct(-F.col("s"), "settlement_id")).alias("settlement_id"), F.lit(1).alias("rung")),
        one(near, 2),
        one(met.where(F.size(F.array_except(_words(a), _words(b))) == 0), 3),
    ]
    best = _all(rungs).groupBy("seg_id").agg(F.min_by("settlement_id", "rung").alias("settlement_id"), F.min("rung").alias("rung"))
    return best


def home_settlements(stations: DataFrame, municipalities: DataFrame, settlements: DataFrame) -> DataFrame:
    """stations(station_id, muni_id, address), municipalities(muni_id, name_norm) -> (station_id, settlement_id, inferred).

    The settlement that the first part of the address names, or else the last one (parts lie between commas); or else the
    settlement that the municipality is named after, which is then inferred. Null where neither is found.
    """
    parts = F.filter(F.transform(F.split("address", ","), lambda p: normalize_street(p)), lambda p: p != "")
    asked = stations.select("station_id", "muni_id", F.posexplode(F.array_distinct(F.array(F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1)))).alias("p", "name"))
    asked = asked.where("name IS NOT NULL").select(F.struct("station_id", "p").alias("seg_id"), "muni_id", "name")
    told = resolve_settlement(asked, settlements).groupBy(F.col("seg_id.station_id").alias("station_id")).agg(F.min_by("settlement_id", "seg_id.p").alias("told"))
    towns = resolve_settlement(municipalities.select(F.col("muni_id").alias("seg_id"), "muni_id", F.col("name_norm").alias("name")), settlements)
    met = stations.select("station_id", "muni_id").join(told, "station_id", "left").join(towns.select(F.col("seg_id").alias("muni_id"), F.col("settlement_id").alias("town")), "muni_id", "left")
    return met.select("station_id", F.coalesce("told", "town").alias("settlement_id"), (F.col("told").isNull() & F.col("town").isNotNull()).alias("inferred"))


def scope_of(label: Column, marker: Column, home: Column, inferred: Column) -> Column:
    """The settlement a segment is asked for in: its own label, a marker where the home is only inferred, else the home."""
    return F.coalesce(label, F.when(inferred, marker), home)


def covered_settlements(resolved: DataFrame, homes: DataFrame, streets: DataFrame) -> DataFrame:
    """resolved(station_id, street_id, method, label, marker), homes(station_id, settlement_id) -> distinct (station_id,
    settlement_id): the home, labels, markers and the settlements of streets found by a method that can be relied on."""
    trusted = resolved.where(F.col("method").isin(*EVIDENCE)).join(streets.select("street_id", "settlement_id"), "street_id").select("station_id", "settlement_id")
    named = resolved.select("station_id", F.explode(F.array("label", "marker")).alias("settlement_id"))
    return trusted.unionByName(named).unionByName(homes.select("station_id", "settlement_id")).where("settlement_id IS NOT NULL").distinct()


def resolve_in_all(segments: DataFrame, covered: DataFrame, streets: DataFrame, settlements: DataFrame) -> DataFrame:
    """Second pass over open segments(seg_id, station_id, muni_id, name, alt) of stations that cover several settlements.

    Each is asked for in every settlement; only methods that stay within it count. One settlement with a hit gives it,
    several are ambiguous; segments without a hit do not come out.
    """
    several = covered.groupBy("station_id").agg(F.count_distinct("settlement_id").alias("n")).where("n > 1").select("station_id")
    asked = segments.join(several, "station_id", "left_semi").join(covered, "station_id")
    inner = asked.select(F.struct("seg_id", F.col("settlement_id").alias("asked")).alias("seg_id"), "muni_id", "settlement_id", "name", F.coalesce("alt", F.lit("")).alias("alt"), F.lit(False).alias("aliased"))
    inner = written(inner, "several")
    hits = _lowest(_all([_by_keys(inner, streets, register_keys(streets)), _by_parts(inner, streets), _by_locality(inner, streets)])).where(F.col("method").isin(*CLEAN))
    placed = hits.join(streets.select(F.col("street_id").cast("string").alias("street_id"), "settlement_id"), "street_id")
    best = placed.groupBy(F.col("seg_id.seg_id").alias("seg_id"), "settlement_id").agg(F.min_by(F.struct("street_id", "method", "score", "extra"), F.struct(-F.col("score"), "seg_id.asked")).alias("v"))
    out = best.groupBy("seg_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("v", "settlement_id").alias("v"), F.array_sort(F.collect_set("v.street_id")).alias("ids"))
    one = F.col("n") == 1
    return out.select(
        "seg_id", F.when(one, F.col("v.street_id")).alias("street_id"), F.when(one, F.col("v.method")).otherwise("ambiguous").alias("method"),
        F.when(one, F.col("v.score")).otherwise(0.0).alias("score"), F.when(one, F.col("v.extra")).otherwise(F.col("ids")).alias("extra"),
    )


INFORMATIONAL = ("parity_unconfirmed", "settlement_claim")


def review(found: DataFrame) -> DataFrame:
    """found(seg_id, method, street_id, dialect, unknown_tokens, kind, source, matched, whole, opponents, unconfirmed) ->
    plus confidence, reasons and needs_review. Informational reasons alone do not ask for a review."""
    m = F.col("method")
    # Confidence by method.
    table = {"ambiguous": 0.2, "osm": 0.5, "fuzzy": 0.5, "proximity": 0.5, "alias": 0.6, "abbrev": 0.6, "manual": 0.9, "base_parts": 0.7, "locality": 0.7, "settlement": 0.8, "muni_fallback": 0.4}
    conf = F.when(F.col("street_id").isNull() & ~m.isin("ambiguous", "osm"), 0.2)
    for name, value in table.items():
        conf = conf.when(m == name, value)
    conf = conf.otherwise(F.when(F.col("dialect") == "structured", 0.95).otherwise(0.75))
    code = F.when(F.col("street_id").isNull() & ~m.isin("ambiguous", "osm"), "street_unresolved").when(m == "osm", "osm_fallback").when(m == "settlement", "settlement_claim")
    code = code.when(m.isin("ambiguous", "fuzzy", "proximity", "alias", "abbrev", "base_parts", "locality", "muni_fallback"), m)
    nums = F.concat_ws("|", F.transform("opponents", lambda x: x.cast("string")))
    reasons = F.array_compact(F.array(
        code, F.when(F.col("unknown_tokens"), "unknown_tokens"), F.when(F.col("kind") == "named_block", "named_block").when(F.col("kind") == "unknown", "unknown_kind"),
        F.when(F.col("source") == "amendment", "amendment"), F.when(~F.col("whole") & ~F.col("matched") & (m != "osm"), "no_match"),
        F.when(F.size("opponents") > 0, F.concat(F.lit("conflict:"), nums)), F.when(F.col("unconfirmed"), "parity_unconfirmed"),
    ))
    flags = F.filter("reasons", lambda r: ~F.substring_index(r, ":", 1).isin(*INFORMATIONAL))
    return found.withColumn("confidence", conf).withColumn("reasons", reasons).withColumn("needs_review", (F.size(flags) > 0).cast("int"))
