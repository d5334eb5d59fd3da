"""Whether two records, or a record and a case, tell of the same incident."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casegraph.functions.dates import days_apart, whole_date
from casegraph.functions.names import best_jaro, compatible, contained, jw, romanized, verified
from casegraph.functions.text import mentions, romanize, surname, tokens
from casegraph.functions.values import DESCRIPTORS
from casegraph.operators.cases import reconcile_rule

# Days and similarities of the gates.
LOOSE_DAYS, STRICT_DAYS, COLLISION_DAYS, FOLLOW_DAYS, VERIFY_DAYS = 14, 3, 30, 30, 10
SAME_INCIDENT_JARO = 0.70


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def places_differ(a: Column, b: Column, place_a: Column, place_b: Column, roman: bool = True) -> Column:
    """Both places are known and differ: by the gazetteer if it knows both, else by name (romanised or as it stands). A missing one never differs."""
    by_name = romanize(a) != romanize(b) if roman else F.lower(F.trim(a)) != F.lower(F.trim(b))
    return ~blank(a) & ~blank(b) & F.when(place_a.isNotNull() & place_b.isNotNull(), place_a != place_b).otherwise(by_name)


def places_agree(a: Column, b: Column, place_a: Column, place_b: Column) -> Column:
    """Both places are known and the same; a missing one never agrees."""
    return F.coalesce(~blank(a) & ~blank(b) & ((F.lower(F.trim(a)) == F.lower(F.trim(b))) | (place_a == place_b)), F.lit(False))


def date_gap(a: Column, b: Column) -> Column:
    return days_apart(a, b)


def city_date_gate(a: dict[str, Column], b: dict[str, Column], loose: bool) -> Column:
    """Struct of ok and reason for two records (city, place, date) whose names don't settle it."""
    differ = places_differ(a["city"], b["city"], a["place"], b["place"])
    gap = date_gap(a["date"], b["date"])
    known = ~blank(a["city"]) | ~blank(b["city"]) | a["date"].isNotNull() | b["date"].isNotNull()
    make = lambda ok, why: F.struct(F.lit(ok).alias("ok"), why.alias("reason"))
    return (
        F.when(differ, make(False, F.lit("city_mismatch")))
        .when(gap > (LOOSE_DAYS if loose else STRICT_DAYS), make(False, F.concat(F.lit("date_mismatch:"), gap.cast("string"), F.lit("d"))))
        .when(known, make(True, F.lit("city_date_match")))
        .otherwise(make(False, F.lit("no_identity_signal")))
    )


def page_names(text: Column, name: Column) -> Column:
    """A page's text holds two of the name's tokens, or the only one that it has; words that describe don't count."""
    words = F.filter(tokens(romanize(name)), lambda t: (F.length(t) >= 2) & ~t.isin(*DESCRIPTORS))
    joined = F.array_join(words, " ")
    return F.coalesce((F.size(words) > 0) & (romanize(text) != "") & mentions(romanize(text), joined), F.lit(False))


def same_case(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Struct of ok and reason for two records (name, city, place, date, text) of one cluster."""
    has_a, has_b = ~blank(a["name"]), ~blank(b["name"])
    match = compatible(romanize(F.trim(a["name"])), romanize(F.trim(b["name"])))
    collide = places_differ(a["city"], b["city"], a["place"], b["place"]) & F.coalesce(date_gap(a["date"], b["date"]) > COLLISION_DAYS, F.lit(False))
    make = lambda ok, why: F.struct(F.lit(ok).alias("ok"), F.lit(why).alias("reason"))
    known = F.when(has_a, F.trim(a["name"])).otherwise(F.trim(b["name"]))
    other = F.when(has_a, b["text"]).otherwise(a["text"])
    return (
        F.when(has_a & has_b, F.when(~match["ok"], match).when(collide, make(False, "city_and_date_mismatch")).otherwise(make(True, "victim_name_match")))
        .when((has_a | has_b) & page_names(other, known), city_date_gate(a, b, True))
        .when(~has_a & ~has_b, city_date_gate(a, b, False))
        .otherwise(make(False, "missing_name_without_identity_signal"))
    )


def weak_secondary(index: Column, name: Column, page: Column, city: Column, place: Column, date: Column, primary: dict[str, Column]) -> Column:
    """Struct of weak and reason: a further victim that the page's title and URL don't name and that shares neither town nor day (within one) with the first."""
    town = ~blank(city) & ~blank(primary["city"]) & ~places_differ(city, primary["city"], place, primary["place"])
    near = F.coalesce(date_gap(date, primary["date"]) <= 1, F.lit(False))
    make = lambda weak, why: F.struct(F.lit(weak).alias("weak"), F.lit(why).alias("reason"))
    return (
        F.when(index == 0, make(False, "primary_virtual"))
        .when(blank(name), make(False, "no_victim_name"))
        .when(page_names(page, name), make(False, "page_identity_mentions_victim"))
        .when(town | near, make(False, "shares_primary_incident_anchor"))
        .otherwise(make(True, "body_only_additional_victim"))
    )


def drop_weak_secondary(records: DataFrame, article: str = "article_id") -> DataFrame:
    """records (article, victim_index, victim_name, page, city, place, incident_date) without weak further victims; the first victim is met by article."""
    first = records.where("victim_index = 0").select(F.col(article).alias("_article"), F.struct(F.col("city"), F.col("place"), F.col("incident_date").alias("date")).alias("_first")).dropDuplicates(["_article"])
    met = records.join(first, records[article] == F.col("_article"), "left").drop("_article")
    rule = weak_secondary(F.col("victim_index"), F.col("victim_name"), F.col("page"), F.col("city"), F.col("place"), F.col("incident_date"), {k: F.col(f"_first.{k}") for k in ("city", "place", "date")})
    return met.withColumn("_weak", rule).where("not _weak.weak").drop("_weak", "_first")


def same_incident(case: dict[str, Column], new: dict[str, Column]) -> Column:
    """Struct of ok and reason: whether a new extraction may be merged into a case.

    case gives cities (array), places (array), names (array), aliases (array) and date, new gives city, place, name and date.
    """
    towns = F.filter(case["cities"], lambda c: c.isNotNull())
    known_town = F.array_contains(towns, new["city"]) | F.coalesce(F.array_contains(case["places"], new["place"]), F.lit(False)) | F.array_contains(romanized(towns), romanize(new["city"])) | (romanize(new["city"]) == "")
    town_ok = blank(new["city"]) | (F.size(towns) == 0) | F.coalesce(known_town, F.lit(False))
    names = F.filter(case["names"], lambda n: n.isNotNull())
    jaro = best_jaro(F.array(romanize(new["name"])), romanized(names))
    long = lambda c: F.filter(c, lambda t: F.length(t) >= 3)
    shared = F.arrays_overlap(long(tokens(romanize(new["name"]))), long(F.flatten(F.transform(romanized(names), tokens))))
    name_ok = blank(new["name"]) | (F.size(names) == 0) | F.coalesce(F.array_contains(case["aliases"], new["name"]), F.lit(False)) | (jaro >= SAME_INCIDENT_JARO) | F.coalesce(shared, F.lit(False))
    # a year that is two or more off is taken for the case's
    moved = F.coalesce(F.try_to_date(F.format_string("%04d-%s", F.year(case["date"]), F.date_format(new["date"], "MM-dd")), "yyyy-MM-dd"), new["date"])
    day = F.when(F.abs(F.year(new["date"]) - F.year(case["date"])) >= 2, moved).otherwise(new["date"])
    gap = date_gap(day, case["date"])
    make = lambda ok, why: F.struct(F.lit(ok).alias("ok"), why.alias("reason"))
    return (
        F.when(~town_ok, make(False, F.concat(F.lit("city_mismatch: '"), new["city"], F.lit("'"))))
        .when(~name_ok, make(False, F.concat(F.lit("name_mismatch: '"), new["name"], F.lit("'"))))
        .when(F.coalesce(gap > FOLLOW_DAYS, F.lit(False)), make(False, F.concat(F.lit("date_mismatch: "), gap.cast("string"), F.lit(" days"))))
        .otherwise(make(True, F.lit("")))
    )


def verify_match(truth: dict[str, Column], case: dict[str, Column]) -> Column:
    """Names agree, or place and day (within ten) do; what is missing never agrees. Both sides give names (array), city, place and date."""
    named = verified(romanized(truth["names"]), romanized(case["names"]))
    near = F.coalesce(date_gap(truth["date"], case["date"]) <= VERIFY_DAYS, F.lit(False))
    return named | (places_agree(truth["city"], case["city"], truth["place"], case["place"]) & near)


def reconcile_pair(a: dict[str, Column], b: dict[str, Column], threshold: float = 0.90) -> Column:
    """The rule by which two cases are one, or null. Sides give names (array, primary), all_names (array), name, city, place, date and urls (array).

    Months that differ veto; so do places, unless the names nearly agree, and a shared source, unless they agree.
    """
    score = best_jaro(romanized(a["names"]), romanized(b["names"]))
    inside = contained(romanized(a["all_names"]), romanized(b["all_names"]))
    ends = [surname(romanize(x["name"])) for x in (a, b)]
    surname_ok = F.coalesce(jw(*ends) >= 0.85, F.lit(True))
    shared = F.coalesce(F.arrays_overlap(a["urls"], b["urls"]), F.lit(False))
    side = lambda x: {"name": F.when(~blank(x["name"]), x["name"]), "city": F.coalesce(x["place"], x["city"]), "date": x["date"]}
    return reconcile_rule(side(a), side(b), score, inside, surname_ok, shared, threshold)


def known_title(titles: DataFrame, cases: DataFrame, threshold: float = 0.85) -> DataFrame:
    """titles (title_id, name, month) that tell of a case (case_name, month) already known: one name holds the other, or they are alike, in one month.

    Rows meet by month and by the first letters of name tokens, not all by all.
    """
    keyed = lambda df, c: df.withColumn("_roman", romanize(F.col(c))).withColumn("_key", F.explode(F.array_distinct(F.transform(tokens(F.col("_roman")), lambda t: F.left(t, F.lit(1))))))
    t = keyed(titles.where(~blank(F.col("name"))), "name").select("title_id", "name", "month", "_roman", "_key")
    c = keyed(cases.where(~blank(F.col("case_name"))), "case_name").select("case_name", F.col("month").alias("_month"), F.col("_roman").alias("_other"), F.col("_key").alias("_key2"))
    met = t.join(c, (F.col("month") == F.col("_month")) & (F.col("_key") == F.col("_key2"))).select("title_id", "name", "case_name", "_roman", "_other").distinct()
    hit = F.contains(F.col("case_name"), F.col("name")) | F.contains(F.col("name"), F.col("case_name")) | (jw(F.col("_roman"), F.col("_other")) >= threshold)
    return met.where(hit).select("title_id").distinct()


def as_date(c: Column) -> Column:
    return whole_date(c)
