"""Clean-up of whole cases with their conflicts: the sanity pass and the quality pass.

A CaseFile holds cases (a row each) and conflicts (a row per case, field, source
and value that differs from the case's). Steps take and return a CaseFile; what a
step decides by a set of conflicting values is an aggregation over that table.
places is the gazetteer as (alias, name_en, district, region), met by place_key().
"""

from __future__ import annotations

from itertools import chain
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from casegraph.functions import values as V
from casegraph.functions.dates import clamp_year
from casegraph.functions.text import tokens
from casegraph.functions.translit import case_id, pure
from casegraph.functions.urls import classify, known_domain, official, publisher_of
from casegraph.operators import cleanup
from casegraph.operators.cases import apply_scores
from casegraph.sources.stores import place_key

NAMES = ("victim_name", "victim_name_ar", "victim_name_he", "victim_name_en")
PLACE_TEXTS = ("arrest_location", "exact_place_type", "neighborhood")


class CaseFile(NamedTuple):
    cases: DataFrame
    conflicts: DataFrame
    places: DataFrame


def _map(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*table.items())]), F.coalesce(key, F.lit("")))


def _flag(flags: Column, name: str, when: Column) -> Column:
    return F.when(when, F.array_union(flags, F.array(F.lit(name)))).otherwise(flags)


def values_of(conflicts: DataFrame, fields, name: str) -> DataFrame:
    """(case_id, name): the fields' conflicting values in order of field and source, without blanks."""
    order = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field"))
    found = conflicts.where(F.col("field").isin(*fields) & (F.coalesce(F.trim("value"), F.lit("")) != ""))
    listed = found.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "source", F.trim("value").alias("value")))).alias("_v"))
    return listed.select(F.col("case_id").alias("_case"), F.col("_v.value").alias(name))


def with_values(cases: DataFrame, conflicts: DataFrame, fields, name: str) -> DataFrame:
    met = cases.join(values_of(conflicts, fields, name), F.col("case_id") == F.col("_case"), "left").drop("_case")
    return met.withColumn(name, F.coalesce(name, F.array().cast("array<string>")))


def with_place(df: DataFrame, places: DataFrame, city: str, name: str = "_place") -> DataFrame:
    """Adds the place's struct (name_en, district, region); null if it isn't known. places has one row per alias."""
    dim = places.select(F.col("alias").alias("_alias"), F.struct("name_en", "district", "region").alias(name))
    return df.join(dim, place_key(F.col(city)) == F.col("_alias"), "left").drop("_alias")


# --- sanity ---


def normalise_sources(f: CaseFile) -> CaseFile:
    """Each source has its publisher and tier by its URL, and the way by which it was found."""
    found = lambda s: F.coalesce(F.nullif(s["discovery_source"], F.lit("")), F.when(s["source_name"].isin("ynet", "panet", "police"), s["source_name"]), F.lit("googlenews"))
    name = lambda s: F.when(found(s) == "googlenews", "Google News").otherwise(found(s))
    done = lambda s: s.withField("tier", classify(s["url"])["tier"]).withField("publisher", publisher_of(s["url"])).withField("source_name", publisher_of(s["url"])).withField("discovery_source", name(s))
    return f._replace(cases=f.cases.withColumn("sources", F.transform("sources", done)))


def modal_year(published: Column) -> Column:
    """The most frequent year of an array of dates, the earliest of several."""
    years = F.transform(F.filter(published, lambda d: d.isNotNull()), F.year)
    ranked = F.transform(F.array_distinct(years), lambda y: F.struct(F.size(F.filter(years, lambda z: z == y)).alias("n"), (-y).alias("y")))
    return -F.array_max(ranked)["y"]


def clamp_dates(f: CaseFile) -> CaseFile:
    """Dates whose year the sources contradict move to the sources' year; a conflicting date within a week of the case's is none."""
    year = modal_year(F.col("sources.published"))
    fixed = f.cases.withColumn("_year", year)
    dates = ("incident_date", "death_date", "incident_date_possible")
    moved = {d: F.when(F.col("_year").isNotNull(), F.coalesce(clamp_year(F.col(d), F.col("_year")), F.col(d))).otherwise(F.col(d)) for d in dates}
    changed = F.lit(False)
    for d in dates:
        changed = changed | F.coalesce(moved[d] != F.col(d), F.lit(False))
    fixed = fixed.withColumn("flags", _flag(F.col("flags"), "date_year_corrected", changed)).withColumns(moved)
    own = fixed.select(F.col("case_id").alias("_case"), "_year", *[F.col(d).alias(f"_{d}") for d in dates[:2]])
    met = f.conflicts.join(own, F.col("case_id") == F.col("_case"), "left")
    day = F.try_to_date(F.substring("value", 1, 10), "yyyy-MM-dd")
    day = F.when(F.col("_year").isNotNull(), F.coalesce(clamp_year(day, F.col("_year")), day)).otherwise(day)
    canon = F.when(F.col("field") == "incident_date", F.col("_incident_date")).when(F.col("field") == "death_date", F.col("_death_date"))
    near = F.coalesce(F.col("_year").isNotNull() & (F.abs(F.date_diff(day, canon)) <= 7), F.lit(False))
    dated = F.col("field").isin(*dates[:2]) & F.col("_year").isNotNull() & day.isNotNull()
    left = met.where(~near).withColumn("value", F.when(dated, day.cast("string")).otherwise(F.col("value")))
    return f._replace(cases=fixed.drop("_year"), conflicts=left.select(f.conflicts.columns))


def script_purity(f: CaseFile) -> CaseFile:
    """A name of mixed scripts becomes an alias; an empty slot takes the main name if that is of its script."""
    slots = {"victim_name_ar": "ar", "victim_name_he": "he", "victim_name_en": "en"}
    mixed = {c: F.coalesce((F.col(c) != "") & ~pure(F.col(c), s), F.lit(False)) for c, s in slots.items()}
    gone = F.filter(F.array(*[F.when(m, F.col(c)) for c, m in mixed.items()]), lambda v: v.isNotNull())
    left = {c: F.when(~mixed[c], F.col(c)) for c in slots}
    filled = {c: F.coalesce(F.nullif(left[c], F.lit("")), F.when(pure(F.col("victim_name"), s), F.col("victim_name"))) for c, s in slots.items()}
    return f._replace(cases=f.cases.withColumn("_gone", gone).withColumns(filled).withColumns({
        "aliases": F.array_union("aliases", "_gone"), "flags": _flag(F.col("flags"), "mixed_script_name_quarantined", F.size("_gone") > 0)}).drop("_gone"))


def split_district(f: CaseFile) -> CaseFile:
    """District and region by the fixed tables, from the case's value and those of its conflicts; such values are no conflict."""
    cases = with_values(f.cases, f.conflicts, ["district"], "_values")
    seen = F.concat(F.when(F.coalesce("district", F.lit("")) != "", F.array("district")).otherwise(F.array().cast("array<string>")), F.col("_values"))
    first = lambda table: F.get(F.filter(F.transform(seen, lambda v: _map(table, v)), lambda v: v.isNotNull()), F.lit(0))
    region = F.coalesce(_map(V.REGIONS, F.col("region")), first(V.REGIONS), F.col("region"))
    cases = cases.withColumns({"district": F.coalesce(first(V.DISTRICTS), F.col("district")), "region": region}).drop("_values")
    benign = (F.col("field") == "district") & F.coalesce(_map(V.DISTRICTS, F.col("value")), _map(V.REGIONS, F.col("value"))).isNotNull()
    return f._replace(cases=cases, conflicts=f.conflicts.where(~F.coalesce(benign, F.lit(False))))


def split_status(f: CaseFile) -> CaseFile:
    return f._replace(cases=cleanup.split_status(f.cases))


def resolve_city(f: CaseFile) -> CaseFile:
    """A town that the gazetteer knows loses its flag and fills district and region."""
    cases = with_place(f.cases, f.places, "city")
    known = F.col("_place").isNotNull()
    fill = lambda c, table: F.when(known & (F.coalesce(c, F.lit("")) == ""), F.coalesce(_map(table, F.col(f"_place.{c}")), F.col(f"_place.{c}"), F.col(c))).otherwise(F.col(c))
    return f._replace(cases=cases.withColumns({
        "flags": F.when(known, F.array_remove("flags", "city:unknown_locality")).otherwise(F.col("flags")),
        "city_en": F.coalesce("_place.name_en", "city_en"), "district": fill("district", V.DISTRICTS), "region": fill("region", V.REGIONS)}).drop("_place"))


def timeline(f: CaseFile) -> CaseFile:
    return f._replace(cases=cleanup.add_timeline(f.cases))


def scores(f: CaseFile) -> CaseFile:
    return f._replace(cases=apply_scores(f.cases))


SANITY = (normalise_sources, clamp_dates, script_purity, split_district, split_status, resolve_city, timeline, scores)


# --- quality ---


def drop_invalid_sources(f: CaseFile) -> CaseFile:
    """Sources of official hosts whose page doesn't look official go, with what they gave to the timeline."""
    keep = lambda s: ~F.coalesce((known_domain(s["url"])["tier"] == 3) & ~official(s["url"]), F.lit(False))
    cases = cleanup.drop_sources(f.cases, keep)
    return f._replace(cases=cases.withColumn("flags", _flag(F.col("flags"), "tier3_invalid_dropped", F.size("dropped_sources") > 0)))


def repair_dates(f: CaseFile) -> CaseFile:
    return f._replace(cases=cleanup.repair_dates(f.cases))


def fill_region(f: CaseFile) -> CaseFile:
    cases = with_place(f.cases, f.places, "city")
    return f._replace(cases=cases.withColumn("region", F.coalesce(F.nullif("region", F.lit("")), "_place.region")).drop("_place"))


def promote_names(f: CaseFile) -> CaseFile:
    """Conflicting names become aliases; aliases that are a main name, or share no token with one, go."""
    cases = with_values(f.cases, f.conflicts, NAMES, "_values")
    main = F.filter(F.array(*NAMES), lambda n: F.coalesce(n, F.lit("")) != "")
    long = lambda c: F.filter(F.split(F.trim(c), r"\s+"), lambda t: F.length(t) >= 2)
    known = F.flatten(F.transform(main, long))
    every = F.array_distinct(F.concat("aliases", "_values"))
    cases = cases.withColumn("aliases", F.filter(every, lambda a: ~F.array_contains(main, a) & F.arrays_overlap(long(a), known))).drop("_values")
    return f._replace(cases=cases, conflicts=f.conflicts.where(~F.col("field").isin(*NAMES)))


def promote_richer_name(f: CaseFile) -> CaseFile:
    """An Arabic alias that holds all of the Arabic name's tokens and more takes its place, the one with most tokens."""
    arabic = F.filter("aliases", lambda a: a.rlike("[؀-ۿ]") & ~a.rlike("[֐-׿]"))
    best = cleanup.richer_name(F.col("victim_name_ar"), arabic)
    new = F.coalesce(F.when(F.coalesce("victim_name_ar", F.lit("")) != "", best), F.col("victim_name_ar"))
    swapped = F.coalesce(new != F.col("victim_name_ar"), F.lit(False))
    return f._replace(cases=f.cases.withColumn("_new", new).withColumns({
        "aliases": F.when(swapped, F.array_union(F.array_remove("aliases", F.col("_new")), F.array("victim_name_ar"))).otherwise(F.col("aliases")), "victim_name_ar": F.col("_new")}).drop("_new"))


def collapse_status(f: CaseFile) -> CaseFile:
    cases = cleanup.collapse_status(with_values(f.cases, f.conflicts, ["suspect_status"], "suspect_conflicts"))
    settled = cases.where(F.size("suspect_conflicts") == 0).select("case_id").withColumn("field", F.lit("suspect_status"))
    return f._replace(cases=cases.drop("suspect_conflicts"), conflicts=f.conflicts.join(settled, ["case_id", "field"], "left_anti").select(f.conflicts.columns))


def resolve_places(f: CaseFile) -> CaseFile:
    """The longest of all descriptions of one place is the case's; if all others overlap with it, there's no conflict."""
    cases, settled = f.cases, None
    words = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}_]+"), lambda t: F.length(t) > 2)
    for field in PLACE_TEXTS:
        cases = with_values(cases, f.conflicts, [field], f"_{field}")
        own = F.when(F.coalesce(field, F.lit("")) != "", F.array(field)).otherwise(F.array().cast("array<string>"))
        ranked = F.transform(F.concat(F.col(f"_{field}"), own), lambda v, i: F.struct((-F.length(v)).alias("n"), i.alias("i"), v.alias("v")))
        cases = cases.withColumn(field, F.when(F.size(f"_{field}") > 0, F.array_min(ranked)["v"]).otherwise(F.col(field)))
        main = F.lower(field)
        alike = F.forall(f"_{field}", lambda v: F.contains(main, F.lower(v)) | F.contains(F.lower(v), main) | F.arrays_overlap(words(v), words(main)))
        done = cases.where((F.size(f"_{field}") > 0) & alike).select("case_id", F.lit(field).alias("field"))
        settled = done if settled is None else settled.unionByName(done)
    return f._replace(cases=cases.drop(*[f"_{x}" for x in PLACE_TEXTS]), conflicts=f.conflicts.join(settled, ["case_id", "field"], "left_anti").select(f.conflicts.columns))


def weak_conflicts(f: CaseFile) -> CaseFile:
    """Other wordings of motive and arrest location are translations; an unknown kind of place contradicts nothing."""
    cases = f.cases
    for field in ("motive", "arrest_location"):
        name = f"{field}_translations"
        cases = with_values(cases, f.conflicts, [field], "_values")
        start = F.coalesce(name, F.array().cast("array<string>")) if name in cases.columns else F.array().cast("array<string>")
        cases = cases.withColumn(name, F.array_union(start, F.col("_values"))).drop("_values")
    void = (F.col("field") == "exact_place_type") & (F.coalesce("value", F.lit("")).isin("", "unknown"))
    return f._replace(cases=cases, conflicts=f.conflicts.where(~F.col("field").isin("motive", "arrest_location") & ~void))


def reset_booleans(f: CaseFile) -> CaseFile:
    """A false that no source contradicts or confirms is unknown."""
    told = f.conflicts.where("field = 'organized_crime'").select(F.col("case_id").alias("_case")).distinct()
    met = f.cases.join(told, F.col("case_id") == F.col("_case"), "left")
    return f._replace(cases=met.withColumn("organized_crime", F.when((F.col("organized_crime") == F.lit(False)) & F.col("_case").isNull(), None).otherwise(F.col("organized_crime"))).drop("_case"))


def clean_conflicts(f: CaseFile) -> CaseFile:
    """Values equal to the case's, or another name of the same place, are no conflict."""
    fields = [c for c, k in f.cases.dtypes if k in ("string", "date", "int", "bigint", "boolean", "double") and c not in ("case_id",)]
    canon = f.cases.select("case_id", *[F.col(c).cast("string").alias(c) for c in fields]).unpivot(["case_id"], fields, "field", "_canon")
    met = f.conflicts.join(canon, ["case_id", "field"], "left").withColumn("_value", F.when(F.col("field").isin("city", "victim_residence"), F.col("value"))).withColumn("_main", F.when(F.col("field").isin("city", "victim_residence"), F.col("_canon")))
    met = with_place(with_place(met, f.places, "_value", "_a"), f.places, "_main", "_b")
    same = F.col("value").eqNullSafe(F.col("_canon")) | F.coalesce(F.col("_a.name_en") == F.col("_b.name_en"), F.lit(False))
    return f._replace(conflicts=met.where(~same).select(f.conflicts.columns))


def better_ids(f: CaseFile) -> CaseFile:
    made = case_id(F.col("incident_date"), F.col("death_date"), F.coalesce("city_en", "city"), F.col("victim_name_en"), F.col("victim_name_ar"), F.col("victim_name_he"), F.col("canonical_case_id"))
    return f._replace(cases=f.cases.withColumn("canonical_case_id", made))


def update_roles(f: CaseFile) -> CaseFile:
    return f._replace(cases=cleanup.add_update_roles(f.cases))


def reevaluate_rejected(f: CaseFile) -> CaseFile:
    """Rejected articles whose town is, by today's gazetteer, the case's are marked for a person to look at."""
    if "rejected" not in f.cases.columns:
        return f
    long = f.cases.select("case_id", "city", F.posexplode("rejected").alias("_i", "_r"))
    long = long.withColumn("_town", F.nullif(F.regexp_extract(F.col("_r.reason"), r"^city_mismatch:\s*'([^']+)'", 1), F.lit("")))
    met = with_place(with_place(long, f.places, "_town", "_a"), f.places, "city", "_b")
    now = F.when(F.col("_a.name_en") == F.col("_b.name_en"), "would_now_match_gazetteer").otherwise(F.col("_r.reevaluated"))
    again = met.groupBy(F.col("case_id").alias("_case")).agg(F.array_sort(F.collect_list(F.struct("_i", F.struct(F.col("_r.url").alias("url"), F.col("_r.reason").alias("reason"), now.alias("reevaluated")).alias("r")))).alias("_all"))
    joined = f.cases.join(again, F.col("case_id") == F.col("_case"), "left")
    return f._replace(cases=joined.withColumn("rejected", F.coalesce(F.col("_all.r"), F.col("rejected"))).drop("_case", "_all"))


QUALITY = (
    drop_invalid_sources, repair_dates, fill_region, promote_names, promote_richer_name, collapse_status, resolve_places, weak_conflicts, reset_booleans,
    clean_conflicts, better_ids, update_roles, reevaluate_rejected,
)


def run(f: CaseFile, steps) -> CaseFile:
    for step in steps:
        f = step(f)
    return f


def sanity_pass(f: CaseFile) -> CaseFile:
    """The eight steps in their order."""
    return run(f, SANITY)


def quality_pass(f: CaseFile) -> CaseFile:
    """The steps in their order; evidence is a table of its own and is merged by cleanup.merge_evidence()."""
    return run(f, QUALITY)


def shared_tokens(a: Column, b: Column) -> Column:
    return F.array_intersect(tokens(a), tokens(b))
