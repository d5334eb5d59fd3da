"""Clean-up of merged cases: each function takes and returns a DataFrame of cases, and they are chained in order.

Columns follow the case schema; a step touches only the columns that it names.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from casegraph.functions.text import tokens

# The axes that a status word belongs to, and the order of progress on an axis.
LEGACY_STATUS = {
    "investigation_open": {"police_investigation_status": "open"},
    "suspect_identified": {"police_investigation_status": "suspect_identified"},
    "arrested": {"suspect_status": "arrested", "police_investigation_status": "suspect_identified"},
    "indictment_pending": {"police_investigation_status": "completed", "legal_status": "pre_indictment"},
    "charged": {"police_investigation_status": "completed", "legal_status": "indicted", "suspect_status": "in_custody"},
    "trial": {"legal_status": "on_trial"},
    "closed_solved": {"police_investigation_status": "closed", "legal_status": "convicted"},
    "closed_unsolved": {"police_investigation_status": "closed"},
}
SUSPECT_WORDS = {
    "arrested": "arrested", "in_custody": "arrested", "in custody": "arrested", "released_on_bail": "released_on_bail",
    "released on bail": "released_on_bail", "wanted": "wanted", "at_large": "at_large", "charged": "arrested",
}
LEGAL_WORDS = {
    "charged": "indicted", "indicted": "indicted", "on_trial": "on_trial", "on trial": "on_trial", "convicted": "convicted",
    "acquitted": "acquitted", "case_closed": "case_closed", "indictment_filed": "indicted",
}
INVESTIGATION_WORDS = {
    "investigation_open": "open", "completed": "completed", "indictment_filed": "indictment_filed", "closed": "closed", "suspect_identified": "suspect_identified",
}
LEGAL_ORDER = ["pre_indictment", "indicted", "on_trial", "convicted", "acquitted", "case_closed"]
INVESTIGATION_ORDER = ["open", "suspect_identified", "completed", "indictment_filed", "closed"]
LEGAL_EVENTS = {"indicted": "Suspect indicted", "on_trial": "Trial began", "convicted": "Conviction reported"}


def lookup(table: dict[str, str], key: Column) -> Column:
    """The value of a small fixed table; null if the key isn't in it."""
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*table.items())]), F.coalesce(key, F.lit("")))


def missing(c: Column) -> Column:
    return c.isNull() | (c == "")


def fill(c: str, value: Column) -> Column:
    return F.when(missing(F.col(c)), F.coalesce(value, F.col(c))).otherwise(F.col(c))


def repair_dates(df: DataFrame) -> DataFrame:
    """A death before its incident swaps with it; a possible date after the incident swaps with it; a missing death follows from an earlier possible date."""
    swap = F.coalesce(F.col("death_date") < F.col("incident_date"), F.lit(False))
    df = df.select("*", F.struct(F.when(swap, F.col("death_date")).otherwise(F.col("incident_date")).alias("i"), F.when(swap, F.col("incident_date")).otherwise(F.col("death_date")).alias("d"), F.col("incident_date_possible").alias("p"), swap.alias("s")).alias("_t"))
    later = F.coalesce(F.col("_t.p") > F.col("_t.i"), F.lit(False))
    incident = F.when(later, F.col("_t.p")).otherwise(F.col("_t.i"))
    possible = F.when(later, F.col("_t.i")).otherwise(F.col("_t.p"))
    death = F.when(F.col("_t.d").isNull() & (possible < incident), incident).otherwise(F.col("_t.d"))
    flags = F.when(F.col("_t.s"), F.array_union("flags", F.array(F.lit("date_chronology_repaired")))).otherwise(F.col("flags"))
    return df.withColumns({"incident_date": incident, "incident_date_possible": possible, "death_date": death, "flags": flags}).drop("_t")


def split_status(df: DataFrame) -> DataFrame:
    """One legacy status fills what is missing on three axes; legal words on the suspect's axis move."""
    key = F.lower("police_status")
    axes = ("suspect_status", "legal_status", "police_investigation_status")
    df = df.withColumns({a: fill(a, lookup({k: v[a] for k, v in LEGACY_STATUS.items() if a in v}, key)) for a in axes})
    moved = lookup({"charged": "indicted", "convicted": "convicted"}, F.col("suspect_status"))
    return df.withColumns({"legal_status": fill("legal_status", moved), "suspect_status": F.when(moved.isNotNull(), "in_custody").otherwise(F.col("suspect_status"))})


def most_advanced(values: Column, order: list[str]) -> Column:
    """The value that comes last in the order; values outside it count as the first."""
    rank = lambda v: F.greatest(F.array_position(F.array(*[F.lit(x) for x in order]), v), F.lit(1))
    return F.array_max(F.transform(values, lambda v: F.struct(rank(v).alias("rank"), v.alias("v"))))["v"]


def collapse_status(df: DataFrame, conflicts: str = "suspect_conflicts") -> DataFrame:
    """Synonyms of one suspect status are no conflict; words of other axes fill those. conflicts is the list of conflicting values."""
    words = lambda t: F.array_distinct(F.filter(F.transform(F.col(conflicts), lambda v: lookup(t, F.lower(v))), lambda v: v.isNotNull()))
    now = F.lower("suspect_status")
    same = F.array_distinct(words(SUSPECT_WORDS))
    agrees = (F.size(same) == 1) & (F.get(same, F.lit(0)) == F.coalesce(lookup(SUSPECT_WORDS, now), now))
    return df.withColumns({
        "legal_status": fill("legal_status", F.coalesce(most_advanced(words(LEGAL_WORDS), LEGAL_ORDER), lookup(LEGAL_WORDS, now))),
        "police_investigation_status": fill("police_investigation_status", F.coalesce(most_advanced(words(INVESTIGATION_WORDS), INVESTIGATION_ORDER), lookup(INVESTIGATION_WORDS, now))),
        conflicts: F.when(F.coalesce(agrees, F.lit(False)), F.array().cast("array<string>")).otherwise(F.col(conflicts)),
        "suspect_status": F.coalesce(lookup(SUSPECT_WORDS, now), F.col("suspect_status")),
    })


def add_timeline(df: DataFrame, sources: str = "sources") -> DataFrame:
    """timeline: dated events from the dates and from each source (url, publisher, published), in order, each (date, event) once."""
    kind = "array<struct<date:date,event:string,confidence:string,source_url:string>>"
    event = lambda d, e, c="high", u=None: F.struct(d.alias("date"), e.alias("event"), F.lit(c).alias("confidence") if isinstance(c, str) else c.alias("confidence"), (u if u is not None else F.lit(None).cast("string")).alias("source_url"))
    first = F.least("incident_date_possible", "incident_date")
    death = F.when(F.col("death_date").isNotNull() & ~F.col("death_date").eqNullSafe(first), F.col("death_date")).when(F.col("death_date").isNull() & (F.col("incident_date") != first), F.col("incident_date"))
    death = F.when(F.col("death_date").isNotNull() & F.col("death_date").eqNullSafe(first) & (F.col("incident_date") != first), F.col("incident_date")).otherwise(death)
    base = F.array(event(first, F.lit("Incident occurred"), F.when(F.col("incident_date_possible").isNotNull(), "medium").otherwise("high")), event(death, F.lit("Victim death reported")))
    dated = F.filter(sources, lambda s: s["published"].isNotNull())
    reports = F.transform(dated, lambda s: event(s["published"], F.concat(F.lit("Reported in "), F.coalesce(s["publisher"], F.lit("media"))), "high", s["url"]))
    latest = F.get(F.filter(F.array_sort(F.transform(dated, lambda s: F.struct(s["published"].alias("published"), s["url"].alias("url")))), lambda s: s["published"] == F.array_max(F.transform(dated, lambda x: x["published"]))), F.lit(0))
    label = lookup(LEGAL_EVENTS, F.col("legal_status"))
    legal = F.when(label.isNotNull(), F.array(event(latest["published"], label, "high", latest["url"]))).otherwise(F.array().cast(kind))
    events = F.filter(F.concat(base.cast(kind), reports.cast(kind), legal.cast(kind)), lambda e: e["date"].isNotNull())
    ordered = F.array_sort(events)
    once = F.filter(ordered, lambda e, i: (i == 0) | ~(F.struct(e["date"], e["event"]) == F.struct(F.get(ordered, i - 1)["date"], F.get(ordered, i - 1)["event"])))
    return df.withColumn("timeline", once)


def add_update_roles(df: DataFrame, sources: str = "sources", days: int = 14) -> DataFrame:
    """Sources published so many days after the incident of an indicted case get the role indictment_update."""
    begun = F.coalesce("incident_date", "death_date")
    late = lambda s: F.coalesce(F.col("legal_status").isin(*LEGAL_EVENTS) & (F.date_diff(s["published"], begun) >= days), F.lit(False))
    roles = lambda s: F.when(late(s), F.array_sort(F.array_union(s["roles"], F.array(F.lit("indictment_update"))))).otherwise(s["roles"])
    return df.withColumn(sources, F.transform(sources, lambda s: s.withField("roles", roles(s))))


def drop_weak_aliases(aliases: Column, *names: Column) -> Column:
    """Aliases that share a token of two letters or more with a primary name."""
    known = F.flatten(F.array(*[F.coalesce(tokens(F.lower(n)), F.array().cast("array<string>")) for n in names]))
    long = F.filter(known, lambda t: F.length(t) >= 2)
    return F.filter(aliases, lambda a: F.arrays_overlap(tokens(F.lower(a)), long))


def drop_sources(df: DataFrame, keep, sources: str = "sources") -> DataFrame:
    """Sources that fail keep go, with the timeline events that they gave; their URLs are listed in dropped_sources."""
    gone = F.transform(F.filter(sources, lambda s: ~keep(s)), lambda s: s["url"])
    df = df.withColumn("dropped_sources", gone)
    return df.withColumns({sources: F.filter(sources, keep), "timeline": F.filter("timeline", lambda e: ~F.coalesce(F.array_contains("dropped_sources", e["source_url"]), F.lit(False)))})


def evidence_signature(kind: Column, description: Column, place: Column, concepts: dict[str, list[str]]) -> Column:
    """Type and concepts that a text mentions in any language, sorted and joined."""
    text = F.concat_ws(" ", F.lower(description), F.lower(place))
    found = [F.when(F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w)), name) for name, words in concepts.items()]
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(F.coalesce(F.lower(kind), F.lit("")), *found), lambda x: x.isNotNull()))), "|")


def merge_evidence(items: DataFrame, case: str, concepts: dict[str, list[str]]) -> DataFrame:
    """One row per case and signature of items (case, type, description, location_found, source_count, lang): descriptions, the English one first, and the largest count."""
    signed = items.withColumn("signature", evidence_signature(F.col("type"), F.col("description"), F.col("location_found"), concepts))
    grouped = signed.groupBy(case, "signature").agg(F.array_sort(F.collect_set(F.struct((F.col("lang") != "en").alias("other"), F.col("description").alias("d")))).alias("_all"), F.max("source_count").alias("source_count"))
    return grouped.select(case, "signature", F.get("_all", F.lit(0))["d"].alias("description"), F.transform(F.slice("_all", F.lit(2), F.size("_all")), lambda x: x["d"]).alias("description_translations"), "source_count")


def richer_name(name: Column, candidates: Column) -> Column:
    """The longest candidate whose tokens hold all of the name's and more; else the name."""
    own = tokens(name)
    better = F.filter(candidates, lambda c: (F.size(F.array_except(own, tokens(c))) == 0) & (F.size(tokens(c)) > F.size(own)))
    best = F.array_max(F.transform(better, lambda c: F.struct(F.size(tokens(c)).alias("n"), c.alias("c"))))["c"]
    return F.coalesce(best, name)


def support_confidence(n: Column, tiers: Column, dissenters: Column, best_effort: bool = False) -> Column:
    """Trust in a value with n supporters of these tiers and so many dissenters."""
    base = F.least(0.6 + 0.07 * n, F.lit(0.90))
    base = F.when(F.array_contains(tiers, 3), F.least(F.lit(1.0), base + 0.10)).otherwise(base)
    base = F.when(F.array_contains(tiers, 1) & F.array_contains(tiers, 2), F.least(F.lit(1.0), base + 0.05)).otherwise(base)
    base = F.when(dissenters > 0, F.greatest(F.lit(0.4), base - 0.10 * dissenters)).otherwise(base)
    base = F.least(base, F.lit(0.85)) if best_effort else base
    return F.when(n == 0, 0.5).otherwise(F.bround(base, 3))


def strict_place(df: DataFrame, place: str, wanted: str) -> DataFrame:
    """Only a known other place drops a row; an unknown one is kept and flagged."""
    known = F.col(place).isNotNull()
    kept = df.where(~known | (F.lower(place) == wanted.lower()))
    return kept.withColumn("flags", F.when(known, F.col("flags")).otherwise(F.array_union("flags", F.array(F.lit("city:unverified")))))


def strict_dates(df: DataFrame, low: str, high: str) -> DataFrame:
    """Only a known date outside the window drops a row; an unknown one is kept and flagged."""
    day = F.coalesce("incident_date", "death_date")
    kept = df.where(day.isNull() | day.between(F.lit(low).cast("date"), F.lit(high).cast("date")))
    return kept.withColumn("flags", F.when(day.isNull(), F.array_union("flags", F.array(F.lit("date:unverified")))).otherwise(F.col("flags")))


def run_all(df: DataFrame) -> DataFrame:
    """The steps that need no dimension, in their order."""
    return df.transform(repair_dates).transform(split_status).transform(collapse_status).transform(add_timeline).transform(add_update_roles)
