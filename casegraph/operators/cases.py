"""Operators on merged cases: reconcile, refine, confidence, provenance and clean-up rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casegraph.functions.dates import same_month
from casegraph.operators.graph import connected_components, label_all

# Weights of the six categories in the overall confidence.
CATEGORY_WEIGHTS = {"case_identity": 0.25, "victim_identity": 0.20, "timeline": 0.15, "legal": 0.15, "location": 0.15, "media": 0.10}


def reconcile_rule(a: dict[str, Column], b: dict[str, Column], score: Column, containment: Column, surname_ok: Column, shared_url: Column, threshold: float = 0.90) -> Column:
    """name_match, name_token_containment, city_date_match or null for a pair of cases.

    a and b give name, city and date. Months or cities that differ veto, unless
    the names nearly agree; a shared source vetoes names that don't.
    """
    both = a["name"].isNotNull() & b["name"].isNotNull()
    one = a["name"].isNotNull() != b["name"].isNotNull()
    cities = F.coalesce(F.lower(a["city"]) != F.lower(b["city"]), F.lit(False))
    strong = both & ((score >= 0.95) | containment)
    alike = both & ((score >= threshold) | containment)
    weak = ~containment & (score >= threshold) & (score < 0.95) & ~surname_ok
    return (
        F.when(~same_month(a["date"], b["date"]), None)
        .when(cities & ~strong, None)
        .when(shared_url & both & ~alike, None)
        .when(shared_url & one, None)
        .when(alike & ~weak, F.when(containment & (score < threshold), "name_token_containment").otherwise("name_match"))
        .when(one & (F.lower(a["city"]) == F.lower(b["city"])) & (a["date"] == b["date"]), "city_date_match")
    )


def merge_groups(cases: DataFrame, links: DataFrame, id_col: str, *strength: Column) -> DataFrame:
    """cases with component and is_canonical: the strongest case of each component, by strength and id."""
    labelled = label_all(cases, connected_components(links, "id_a", "id_b"), id_col)
    w = Window.partitionBy("component").orderBy(*strength, F.col(id_col))
    return labelled.withColumn("is_canonical", F.row_number().over(w) == 1)


def absorb(grouped: DataFrame, group: str, scalars: list[str], lists: list[str], *order: Column) -> DataFrame:
    """One row per group: scalars from the strongest row that has them, lists as ordered unions."""
    rank = F.struct(*order)
    return grouped.groupBy(group).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in scalars],
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists],
    )


def merge_provenance(members: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    """Rule by which each member meets its component's smallest member, or transitive."""
    rules = links.select(F.col("id_a").alias("component"), F.col("id_b").alias("_id"), F.col("rule").alias("_rule"))
    met = members.alias("m").join(rules.alias("r"), (F.col("m.component") == F.col("r.component")) & (F.col(f"m.{id_col}") == F.col("r._id")), "left")
    return met.select("m.*", F.when(F.col(f"m.{id_col}") == F.col("m.component"), "root").otherwise(F.coalesce("r._rule", F.lit("transitive"))).alias("reason"))


def refine(members: DataFrame, cluster: str, id_col: str, links: DataFrame, named: Column) -> DataFrame:
    """Splits clusters to components of their own links; an unnamed member joins only if it meets exactly one named component."""
    known = label_all(members.where(named), connected_components(links, "id_a", "id_b"), id_col)
    unnamed = members.where(~named)
    counts = known.groupBy(cluster).agg(F.count_distinct("component").alias("_n"), F.min("component").alias("_only"))
    placed = unnamed.join(counts, cluster, "left").withColumn("component", F.when(F.col("_n") == 1, F.col("_only")).otherwise(F.col(id_col))).drop("_n", "_only")
    return known.unionByName(placed)


def filled(*cols: Column) -> Column:
    return sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cols), F.lit(0))


def case_identity(fields: list[Column], n_sources: Column, corrected: Column) -> Column:
    base = F.least(F.lit(1.0), filled(*fields) / 4 + F.when(n_sources >= 2, 0.1).otherwise(0.0))
    return base * F.when(corrected, 0.95).otherwise(1.0)


def media_confidence(n: Column, missing: Column) -> Column:
    base = F.when(n == 0, 0.05).when(n == 1, 0.4).when(n <= 3, 0.7).otherwise(F.least(F.lit(1.0), 0.7 + 0.05 * (n - 3)))
    return F.when(missing, F.least(base, F.lit(0.3))).otherwise(base)


def victim_identity(names: list[Column], others: list[Column], ar: Column, he: Column, n_aliases: Column, quarantined: Column) -> Column:
    base = F.least(F.lit(1.0), filled(*names) / 3 * 0.5 + filled(*others) / 4 * 0.5)
    base = F.when(ar.isNotNull() & he.isNotNull(), F.least(F.lit(1.0), base + 0.15)).otherwise(base)
    base = F.when(n_aliases >= 1, F.least(F.lit(1.0), base + 0.05 * F.least(n_aliases, F.lit(3)))).otherwise(base)
    return F.when(quarantined, base * 0.9).otherwise(base)


def timeline_confidence(incident: Column, death: Column, time: Column, possible: Column, conflict: Column, n_events: Column) -> Column:
    """Penalties hold only while the dates contradict each other."""
    coherent = F.coalesce(incident <= death, F.lit(False)) & F.coalesce(possible <= incident, F.lit(True))
    base = filled(incident, death, time) / 3
    base = F.when(conflict & ~coherent, base * 0.6).otherwise(base)
    base = F.when(possible.isNotNull() & ~coherent, base * 0.85).otherwise(base)
    return F.when(n_events >= 4, F.least(F.lit(1.0), base + 0.15)).otherwise(base)


def legal_confidence(fields: list[Column], suspect: Column, n_sources: Column, tier_1: Column, tier_2: Column, tier_3: Column) -> Column:
    """fields are the five of the legal axis; the tiers' columns count sources."""
    base = F.least(F.lit(1.0), filled(*fields) / 5)
    base = F.when(suspect.isNotNull(), F.least(F.lit(1.0), base + 0.05 * F.least(n_sources, F.lit(6)))).otherwise(base)
    base = F.when((tier_1 >= 2) & (tier_2 >= 1), F.least(F.lit(1.0), base + 0.1)).otherwise(base)
    return F.when(tier_3 > 0, F.least(F.lit(1.0), base + 0.10)).when(tier_1 + tier_2 >= 4, F.least(base, F.lit(0.85))).otherwise(F.least(base, F.lit(0.65)))


def location_confidence(fields: list[Column], tier_2: Column) -> Column:
    base = F.least(F.lit(1.0), filled(*fields) / 6)
    return F.when(tier_2 > 0, base).otherwise(F.least(base, F.lit(0.7)))


def overall_confidence(categories: dict[str, Column]) -> Column:
    return F.bround(sum((categories[k] * w for k, w in CATEGORY_WEIGHTS.items()), F.lit(0.0)), 3)


def category_scores(df: DataFrame) -> dict[str, Column]:
    """The six scores of cases by the case schema's columns; a column that isn't there is empty."""

    def col(c: str) -> Column:
        if c not in df.columns:
            return F.lit(None).cast("string")
        return F.nullif(F.col(c), F.lit("")) if dict(df.dtypes)[c] == "string" else F.col(c)

    def size(c: str) -> Column:
        return F.coalesce(F.size(F.filter(c, lambda x: x.isNotNull())), F.lit(0)) if c in df.columns else F.lit(0)

    flag = lambda name: F.array_contains("flags", name)
    tier = lambda t: F.size(F.filter("sources", lambda s: s["tier"] == t))
    many = lambda *names: [col(n) for n in names]
    out = {
        "case_identity": case_identity(many("incident_date", "city", "num_victims", "canonical_case_id"), size("sources"), flag("date_year_corrected")),
        "victim_identity": victim_identity(
            many("victim_name_ar", "victim_name_he", "victim_name_en"), many("victim_age", "victim_gender", "victim_profession", "victim_residence"),
            col("victim_name_ar"), col("victim_name_he"), size("aliases"), flag("mixed_script_name_quarantined"),
        ),
        "timeline": timeline_confidence(col("incident_date"), col("death_date"), col("incident_time"), col("incident_date_possible"), flag("date_conflict_possible"), size("timeline")),
        "legal": legal_confidence(many("suspect_status", "legal_status", "police_investigation_status", "suspect_name", "arrest_location"), col("suspect_status"), size("sources"), tier(1), tier(2), tier(3)),
        "location": location_confidence(many("city", "neighborhood", "district", "region", "exact_place_type", "hospital"), tier(2)),
        "media": media_confidence(size("media"), flag("needs_media_extraction")),
    }
    return {k: F.bround(v, 3) for k, v in out.items()}


def tier_coverage(sources: Column) -> Column:
    """Map of tier_1, tier_2, tier_3 and untiered to the publishers of the sources."""

    def names(tiers: tuple, inside: bool) -> Column:
        kept = F.filter(sources, lambda s: F.coalesce(s["tier"].isin(*tiers), F.lit(False)) == F.lit(inside))
        return F.transform(kept, lambda s: F.coalesce(s["publisher"], F.lit("Unknown")))

    return F.create_map(*[x for t in (1, 2, 3) for x in (F.lit(f"tier_{t}"), names((t,), True))], F.lit("untiered"), names((1, 2, 3), False))


def apply_scores(df: DataFrame) -> DataFrame:
    """Adds the six scores, the overall one, the tiers' coverage and a flag for each tier that is missing."""
    made = category_scores(df)
    kept = F.filter("flags", lambda f: ~F.startswith(f, F.lit("needs_tier_")))
    gaps = F.transform(F.array_except(F.array(F.lit(1), F.lit(2), F.lit(3)), F.transform(F.filter("sources", lambda s: s["tier"].isNotNull()), lambda s: s["tier"])), lambda t: F.concat(F.lit("needs_tier_"), t.cast("string")))
    df = df.withColumn("confidence", F.struct(*[v.alias(k) for k, v in made.items()]))
    overall = F.least(F.lit(1.0), overall_confidence({k: F.col(f"confidence.{k}") for k in made}))
    return df.withColumns({"confidence_score": F.bround(overall, 3), "tier_coverage": tier_coverage(F.col("sources")), "flags": F.concat(kept, gaps)})


def provenance(rows: DataFrame, case: str, source: str, fields: list[str]) -> DataFrame:
    """Per case, field and value: supporters, dissenters and the share of support."""
    long = rows.select(case, source, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot([case, source], fields, "field", "value").where("value is not null")
    support = long.groupBy(case, "field", "value").agg(F.count_distinct(source).alias("supporters"))
    every = long.groupBy(case, "field").agg(F.count_distinct(source).alias("_all"))
    return support.join(every, [case, "field"]).select(case, "field", "value", "supporters", (F.col("_all") - F.col("supporters")).alias("dissenters"), F.bround(F.col("supporters") / F.col("_all"), 3).alias("support"))


def tier_gaps(tiers: Column) -> Column:
    """Flags for the tiers of 1 to 3 that are missing."""
    return F.transform(F.array_except(F.array(F.lit(1), F.lit(2), F.lit(3)), tiers), lambda t: F.concat(F.lit("missing_tier_"), t.cast("string")))


def flags_with(flags: Column, add: Column, when: Column) -> Column:
    return F.when(when, F.array_union(flags, F.array(add))).otherwise(F.array_remove(flags, add))
