"""Filters and gates on records, cases and titles; each keeps rows or names a reason, and says what missing values do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casegraph.functions import values as V
from casegraph.functions.text import first_present, holds_any, present, tokens
from casegraph.operators.tables import first_reason, latest

NAMES = ("victim_name", "victim_name_ar", "victim_name_he", "victim_name_en")


def has(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("")) != ""


def any_name(*columns: str) -> Column:
    return F.greatest(*[has(c) for c in columns])


def case_name() -> Column:
    return first_present(F.col("victim_name_ar"), F.col("victim_name_he"), F.col("victim_name_en"), F.col("victim_name"))


# --- relevance ---


def homicide_reason(df: DataFrame, names=NAMES) -> Column:
    """Why an extraction is kept or left out: incident_type:<other>, victim_survived, kept or no_homicide_signal; a row without data is no_extraction_data."""
    kind = F.col("incident_type")
    outcome = F.coalesce(F.col("victim_outcome"), F.lit(""))
    aliases = F.exists("victim_aliases", present) if "victim_aliases" in df.columns else F.lit(False)
    signal = F.greatest(*[present(F.col(n)) for n in names if n in df.columns], F.coalesce(aliases, F.lit(False)), present(F.col("city"))) | F.col("incident_date").isNotNull() | F.col("death_date").isNotNull() | outcome.isin("died", "critical")
    none = F.col("has_data") == F.lit(False) if "has_data" in df.columns else F.lit(False)
    return (
        F.when(none, "no_extraction_data")
        .when(kind.isin(*V.OTHER_TYPES), F.concat(F.lit("incident_type:"), kind))
        .when(outcome == "survived", "victim_survived")
        .when(kind.isin(*V.HOMICIDE_TYPES), "kept")
        .otherwise(F.when(signal, "kept").otherwise("no_homicide_signal"))
    )


def relevant(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that are kept, and the reasons with their counts."""
    told = df.withColumn("reason", homicide_reason(df))
    return told.where("reason = 'kept'").drop("reason"), told.groupBy("reason").agg(F.count("*").alias("n"))


def triage_status(category: Column, seen: Column) -> Column:
    """yes, maybe or no by a verdict's category; an unknown category is maybe, and a row without verdict passes."""
    known = F.lower(F.trim(category))
    status = F.when(known.isin(*V.HOMICIDE_TYPES), "yes").when(known.isin(*V.OTHER_TYPES), "no").otherwise("maybe")
    return F.when(seen, status).otherwise("pass")


# --- final filters ---


def final_filter(cases: DataFrame, low: str, high: str, allowed=V.ALLOWED_GEOGRAPHY) -> DataFrame:
    """Cases of a death, with a name, a date in the window and an allowed or missing geography."""
    day = F.col("incident_date").between(F.lit(low).cast("date"), F.lit(high).cast("date"))
    place = F.col("incident_geography").isin(*allowed) | F.col("incident_geography").isNull()
    return cases.where((F.col("victim_outcome") == "died") & case_name().isNotNull() & day & place)


def exclude_survived(cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cases that aren't told to be survived, and how many were left out."""
    alive = F.coalesce(F.col("victim_outcome") == "survived", F.lit(False))
    return cases.where(~alive), cases.agg(F.count_if(alive).alias("non_fatal_excluded"), F.count_if(~alive).alias("cases_exported"))


def any_in_window(day: Column, more: Column, low: str, high: str) -> Column:
    """The record's day, or one of its further days, lies in the window."""
    inside = lambda d: F.coalesce(d.between(F.lit(low).cast("date"), F.lit(high).cast("date")), F.lit(False))
    return inside(day) | F.coalesce(F.exists(more, inside), F.lit(False))


def place_filter(df: DataFrame, places: DataFrame, city: str, wanted: str) -> DataFrame:
    """Only a town that the gazetteer knows as another one drops a row; an unknown town is kept and flagged."""
    from casegraph.operators.casefile import with_place

    met = with_place(df, places, city)
    flags = F.when(F.col("_place").isNull(), F.array_union("flags", F.array(F.lit("city:unverified")))).otherwise(F.col("flags"))
    return met.where(F.col("_place").isNull() | (F.lower("_place.name_en") == wanted.lower())).withColumn("flags", flags).drop("_place")


# --- titles and queries ---


def all_terms(text: Column, query: str) -> Column:
    """Each word of the query stands in the text, in any case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(True)
    for word in query.lower().split():
        out = out & F.contains(low, F.lit(word))
    return out


def title_without_date(title: Column) -> Column:
    return F.trim(F.regexp_replace(title, r"\s*\d{1,2}[./]\d{1,2}[./]\d{2,4}\s*(?:-?\s*\d{1,2}:\d{2})?\s*$", ""))


def title_has(title: Column, words) -> Column:
    """A word stands in the title, the date at its end left out."""
    return F.coalesce(holds_any(title_without_date(title), words), F.lit(False))


def followup_title(title: Column) -> Column:
    return F.coalesce(holds_any(title, V.FOLLOWUP_MARKERS), F.lit(False))


def rollup_title(title: Column, n_additional: Column, least: int = 5) -> Column:
    """The title counts victims and the extraction names so many further ones."""
    return F.coalesce(title.rlike(V.ROLLUP_TITLE), F.lit(False)) & (F.coalesce(n_additional, F.lit(0)) >= least)


def injury_only(cases: DataFrame, titles: DataFrame) -> DataFrame:
    """Cases of one source whose title (url, title) speaks of an injury."""
    one = cases.where(F.size("sources") == 1).withColumn("_url", F.get("sources", F.lit(0))["url"])
    met = one.join(titles.select(F.col("url").alias("_u"), "title"), F.col("_url") == F.col("_u"))
    return met.where(holds_any(F.col("title"), V.INJURY_MARKERS)).drop("_url", "_u")


# --- outliers and decontamination ---


def outlier_category(df: DataFrame) -> Column:
    """The first category that holds, else null: low_confidence, bad_geography, no_name, not_died, rollup_only_single_source."""
    title = F.coalesce(F.get("sources", F.lit(0))["title"], F.lit(""))
    rules = [
        ("low_confidence", F.coalesce("confidence_score", F.lit(0.0)) < 0.4),
        ("bad_geography", ~F.coalesce("incident_geography", F.lit("")).isin("israel_arab_society", "")),
        ("no_name", ~any_name(*[n for n in NAMES if n in df.columns])),
        ("not_died", ~F.coalesce(F.col("victim_outcome") == "died", F.lit(False))),
        ("rollup_only_single_source", (F.size("sources") == 1) & holds_any(title, V.ROLLUP_MARKERS)),
    ]
    return F.nullif(first_reason(rules, ""), F.lit(""))


def outliers(df: DataFrame) -> DataFrame:
    return df.withColumn("category", outlier_category(df)).where("category is not null")


def surnames(names: Column, least: int = 4) -> Column:
    """Last tokens of so many letters or more."""
    last = F.transform(F.filter(names, lambda n: F.coalesce(F.trim(n), F.lit("")) != ""), lambda n: F.element_at(tokens(n), -1))
    return F.array_distinct(F.filter(last, lambda t: F.length(t) >= least))


def decontaminate(cases: DataFrame, sources: DataFrame, articles: DataFrame) -> DataFrame:
    """sources (case_id, url) whose article (url, text) names the case's victim in full or by surname; without a text a source is kept.

    cases gives case_id and names (array).
    """
    met = sources.join(cases.select("case_id", "names", surnames(F.col("names")).alias("_last")), "case_id").join(articles.select(F.col("url").alias("_u"), F.col("text").alias("_text")), F.col("url") == F.col("_u"), "left")
    named = F.exists(F.concat(F.filter("names", lambda n: F.coalesce(n, F.lit("")) != ""), "_last"), lambda n: F.contains(F.col("_text"), n))
    return met.where((F.coalesce("_text", F.lit("")) == "") | F.coalesce(named, F.lit(False))).select(sources.columns)


def surname_aliases(aliases: Column, names: Column) -> Column:
    """Aliases whose last token is a surname of the case."""
    last = surnames(names)
    return F.filter(aliases, lambda a: F.array_contains(last, F.element_at(tokens(a), -1)))


# --- views ---


def case_summary(df: DataFrame) -> DataFrame:
    """The list view's row of a case: its fields, and the sizes of its lists."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0)) if c in df.columns else F.lit(0)
    own = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in V.SUMMARY_FIELDS]
    keys = [F.col(c) for c in ("case_index", "run_id") if c in df.columns]
    flags = F.coalesce("flags", F.array().cast("array<string>")).alias("flags")
    counts = [size("sources").alias("source_count"), flags, (size("media") + size("media_evidence")).alias("media_count"), F.col("canonical_case_id")]
    return df.select(*keys, *own, *counts)


def list_filter(df: DataFrame, city: str | None = None, district: str | None = None, outcome: str | None = None, weapon_type: str | None = None, search: str | None = None, min_confidence: float = 0.0, review_status: str | None = None, date_from: str | None = None, date_to: str | None = None, flagged: bool | None = None, named_only: bool = True) -> DataFrame:
    """Summaries that pass all given predicates. A missing date passes the date range; a missing field passes no other one."""
    rules = []
    if city:
        rules.append(F.contains(F.lower(F.coalesce("city", F.lit(""))), F.lit(city.lower())))
    for c, v in (("district", district), ("victim_outcome", outcome), ("weapon_type", weapon_type), ("review_status", review_status)):
        if v:
            rules.append(F.coalesce(F.col(c) == v, F.lit(False)))
    if search:
        rules.append(F.greatest(*[F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(search.lower())) for c in NAMES[:3]]))
    rules.append(F.coalesce("confidence_score", F.lit(0.0)) >= min_confidence)
    if date_from:
        rules.append(F.coalesce(F.col("incident_date") >= F.lit(date_from).cast("date"), F.lit(True)))
    if date_to:
        rules.append(F.coalesce(F.col("incident_date") <= F.lit(date_to).cast("date"), F.lit(True)))
    if flagged is not None:
        rules.append((F.size("flags") > 0) == F.lit(flagged))
    if named_only:
        rules.append(F.coalesce("victim_name", F.lit("")) != "")
    for rule in rules:
        df = df.where(rule)
    return df


def ui_filter(df: DataFrame, active: str, year: int, search: str = "") -> DataFrame:
    """The front page's list: all, the current year or a region; the search looks into all names, towns and transliterations."""
    if active == "current-year":
        df = df.where(F.year("incident_date") == year)
    elif active != "all":
        df = df.where(F.col("region") == active)
    q = search.strip().lower()
    if not q:
        return df
    texts = [c for c in ("victim_name_ar", "victim_name_he", "victim_name_en", "city_ar", "city_he", "city_en") if c in df.columns]
    hit = F.greatest(F.lit(False), *[F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(q)) for c in texts])
    if "name_transliterations" in df.columns:
        hit = hit | F.coalesce(F.exists("name_transliterations", lambda t: F.contains(F.lower(t["value"]), F.lit(q))), F.lit(False))
    return df.where(hit)


def photos(media: DataFrame, surname_tokens: str = "surnames", city_tokens: str = "city_tokens", per_type: int = 2, most: int = 8) -> DataFrame:
    """The photos that a case's page shows: useful ones, of this victim and town, two of a type and eight in all, the surest first.

    media: case_id, primary_url, type, is_evidence, text, classifier_tier, confidence, pos, and the case's surnames and city tokens.
    """
    markers = "المرحوم|مرحوم|المغدور|مغدور|الضحية|ضحية|الضحايا|ضحايا|ضحيتا|الشهيد|شهيد|الراحل|القتيل|الشاب|המנוח|הקרבן|הקרבנות"
    inside = lambda words: F.coalesce(F.exists(words, lambda w: F.contains(F.col("text"), w)), F.lit(False))
    other_victim = F.col("text").rlike(markers) & ~inside(surname_tokens)
    other_place = F.coalesce(F.col("type").isin("crime_scene", "police_activity"), F.lit(False)) & (F.col("text") != "") & ~inside(city_tokens)
    useful = F.col("is_evidence") | F.coalesce(F.col("type").isin(*V.MEANINGFUL), F.lit(False))
    kept = media.where(F.col("primary_url").isNotNull() & useful & ~other_victim & ~other_place)
    kept = latest(kept, ["case_id", "primary_url"], F.col("pos"))
    order = [F.when(F.col("classifier_tier") == "keyword", 0).when(F.col("classifier_tier") == "clip", 1).otherwise(2), F.desc(F.coalesce("confidence", F.lit(0.0))), F.col("pos")]
    from casegraph.operators.tables import top_k

    return top_k(top_k(kept.withColumn("_kind", F.coalesce("type", F.lit("other"))), ["case_id", "_kind"], per_type, *order), ["case_id"], most, *order).drop("_kind")


def weak_cases(df: DataFrame) -> DataFrame:
    """Cases that lack a name or an outcome, which enrichment looks at."""
    return df.where(~has("victim_name") | ~has("victim_outcome"))


def coverage_flags(df: DataFrame) -> DataFrame:
    """Flags for what a case's sources don't cover: Arabic ones, two Hebrew ones, media, premium and cut bodies."""
    lang = lambda code: F.size(F.filter("sources", lambda s: F.coalesce(s["language"] == code, F.lit(False))))
    put = lambda flags, name, when: F.when(when, F.array_union(flags, F.array(F.lit(name)))).otherwise(flags)
    flags = F.when(lang("ar") > 0, F.array_remove("flags", "needs_arabic_sources")).otherwise(F.array_union("flags", F.array(F.lit("needs_arabic_sources"))))
    flags = F.when(lang("he") >= 2, F.array_remove(flags, "needs_hebrew_investigation_sources")).otherwise(flags)
    flags = put(flags, "needs_media_extraction", F.coalesce(F.size("media"), F.lit(0)) <= 0)
    flags = put(flags, "premium_source", F.exists("sources", lambda s: F.coalesce(s["paywalled"], F.lit(False))))
    return df.withColumn("flags", put(flags, "needs_full_body_source", F.exists("sources", lambda s: ~F.coalesce(s["body_extracted"], F.lit(True)))))
