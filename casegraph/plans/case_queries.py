"""Registered queries of the case operators, each over the operator itself, with DuckDB counterparts.

CASES is one view in SQL that both engines read: orders as cases, with names,
places, dates and outcomes made of the supplied columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casegraph.functions import captions, html, names, text, translit, urls, values as V
from casegraph.operators import absorb, casefile, cases as C, cleanup, gallery, identity, pairs, resolve, selection, tables
from casegraph.plans import stages
from casegraph.plans.registry import query
from casegraph.sources import connectors, exports, scans
from casegraph.sources.stores import table
from casegraph.streaming.ingest import windowed_counts

CASES = """
select o_orderkey as case_id, o_custkey as cust, o_totalprice as price, p_name as part_name, c_mktsegment as segment,
 case when o_orderkey % 9 = 0 then null else p_name end as victim_name_en,
 case o_orderkey % 6 when 0 then 'محمد سالم' when 1 then 'بكر محمود ياسين' when 2 then 'بكر ياسين' when 3 then 'أحمد نصار' end as victim_name_ar,
 case o_orderkey % 5 when 0 then 'בכר יאסין' when 1 then 'חסן abc' end as victim_name_he,
 case when o_orderkey % 4 = 0 then null else p_name end as victim_name,
 case when o_orderkey % 7 = 0 then null else n_name end as city, r_name as region_name,
 case o_orderkey % 8 when 0 then 'צפון' when 1 then 'גליל' when 2 then 'Northern' when 3 then 'Elsewhere' when 4 then 'Haifa' end as district,
 cast(o_orderdate as date) as day,
 case when o_orderkey % 13 = 0 then null else cast(o_orderdate as date) end as incident_date,
 case when o_orderkey % 3 = 0 then cast(o_orderdate as date) when o_orderkey % 3 = 1 then cast(o_orderdate as date) + 5 end as death_date,
 case o_orderkey % 5 when 0 then 'survived' when 1 then 'critical' when 2 then null else 'died' end as victim_outcome,
 case o_orderkey % 6 when 0 then 'homicide' when 1 then 'accident' when 2 then 'unknown' when 3 then 'attempted_homicide' when 4 then 'non_crime' end as incident_type,
 case o_orderkey % 4 when 0 then 'israel_arab_society' when 1 then 'unknown' when 2 then 'abroad' end as incident_geography,
 o_orderpriority as weapon_type, o_orderstatus as review_status, cast(o_orderkey % 100 as double) / 100 as confidence_score, cast(o_orderkey % 91 as int) as victim_age
from {orders} left join {customer} on o_custkey = c_custkey left join {nation} on c_nationkey = n_nationkey
 left join {region} on n_regionkey = r_regionkey left join {part} on p_partkey = o_custkey
"""
_TABLES = ("orders", "customer", "nation", "region", "part")
_C = f"c as ({CASES.format(**{t: t for t in _TABLES})})"
#: How many sources, images and events a case has in both engines.
_N = "(case_id % 5)"


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CASES, **{t: table(spark, sf_dir, t) for t in _TABLES})


def file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with lists: aliases, flags, sources, media and timeline."""
    k = F.col("case_id")
    some = lambda **named: F.filter(F.array(*[F.when(k % n == 0, name) for name, n in named.items()]), lambda x: x.isNotNull())
    source = lambda i: F.struct(
        F.concat(F.lit("https://www."), F.element_at(F.array(F.lit("ynet.co.il"), F.lit("arab48.com"), F.lit("police.gov.il"), F.lit("blog.example.org")), i), F.when(i == 3, F.when(k % 2 == 0, "/forms/").otherwise("/news/")).otherwise("/a/"), k.cast("string")).alias("url"),
        F.when(i < 4, i).cast("int").alias("tier"), F.concat(F.lit("P"), i.cast("string")).alias("publisher"), F.when(i % 2 == 0, "ar").otherwise("he").alias("language"), F.date_add("day", (i * 7).cast("int")).alias("published"),
        F.lit("").alias("discovery_source"), F.lit("googlenews").alias("source_name"), F.array().cast("array<string>").alias("roles"), F.when((k % 11 == 0) & (i == 1), V.ROLLUP_MARKERS[0]).otherwise("title").alias("title"),
        (k % 100 / 100).alias("confidence_score"), (i == 4).alias("paywalled"), (i != 2).alias("body_extracted"),
    )
    upto = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("int"), n.cast("int")), f)).otherwise(F.transform(F.array().cast("array<int>"), f))
    return cases(spark, sf_dir).withColumns({
        "aliases": F.when(k % 3 == 0, F.array(F.concat("part_name", F.lit(" senior")), F.col("segment"))).otherwise(F.array().cast("array<string>")),
        "flags": some(date_year_corrected=10, needs_media_extraction=6, mixed_script_name_quarantined=15, date_conflict_possible=4, single_source=8),
        "sources": upto(k % 5, source), "media": upto(k % 6, lambda i: F.struct(i.alias("media_id"))), "timeline": upto(k % 7, lambda i: F.struct(F.col("day").alias("date"), F.lit("e").alias("event"), F.lit(None).cast("string").alias("source_url"))),
        "canonical_case_id": F.when(k % 17 != 0, F.concat(F.lit("ID-"), k.cast("string"))), "incident_date_possible": F.when(k % 12 == 0, F.date_add("day", -1)).when(k % 12 == 1, F.date_add("day", 1)),
    })


_FLAG = {"date_year_corrected": 10, "needs_media_extraction": 6, "mixed_script_name_quarantined": 15, "date_conflict_possible": 4, "single_source": 8}
_FLAGS = "array_to_string(list_filter([" + ", ".join(f"case when case_id % {n} = 0 then '{f}' end" for f, n in _FLAG.items()) + "], lambda x: x is not null), ',')"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the gazetteer: each under its name, and every third under a second one."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    alias = F.array(F.lower("n_name"), F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("old "), F.lower("n_name"))))
    return n.select(F.explode(F.filter(alias, lambda a: a.isNotNull())).alias("alias"), F.col("n_name").alias("name_en"), F.when(F.col("n_nationkey") % 2 == 0, "Northern").alias("district"), F.col("r_name").alias("region"), (F.col("n_nationkey") + 0.5).alias("lat"), F.when(F.col("n_nationkey") != 5, 1.5).alias("lng"))


# --- relevance, triage, filters ------------------------------------------------------------

_REASON = """case when incident_type in ('accident', 'non_crime') then 'incident_type:' || incident_type when victim_outcome = 'survived' then 'victim_survived' when incident_type in ('homicide', 'attempted_homicide') then 'kept'
 when trim(coalesce(victim_name, '')) <> '' or victim_name_ar is not null or victim_name_he is not null or victim_name_en is not null or city is not null or incident_date is not null or death_date is not null or victim_outcome in ('died', 'critical') then 'kept' else 'no_homicide_signal' end"""


@query(f"with {_C} select case_id, incident_type from c where {_REASON} = 'kept'")
def relevance_gate(spark, sf_dir):
    return selection.relevant(cases(spark, sf_dir))[0].select("case_id", "incident_type")


@query(f"with {_C} select {_REASON} as reason, count(*) as n from c group by 1")
def relevance_reasons(spark, sf_dir):
    return selection.relevant(cases(spark, sf_dir))[1]


@query(f"with {_C} select case_id, case when doc_id is null then 'pass' when incident_type in ('homicide', 'attempted_homicide') then 'yes' when incident_type in ('accident', 'non_crime') then 'no' else 'maybe' end as status from c left join (select distinct doc_id from labels) on doc_id = case_id")
def triage_pass(spark, sf_dir):
    seen = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_d")).distinct()
    met = cases(spark, sf_dir).join(seen, F.col("_d") == F.col("case_id"), "left")
    return met.select("case_id", selection.triage_status(F.col("incident_type"), F.col("_d").isNotNull()).alias("status"))


@query(f"""with {_C} select case_id from c where victim_outcome = 'died' and (victim_name is not null or victim_name_ar is not null or victim_name_he is not null or victim_name_en is not null)
 and incident_date between date '1996-01-01' and date '1998-12-31' and (incident_geography is null or incident_geography in ('israel_arab_society', 'unknown'))""")
def final_filter(spark, sf_dir):
    return selection.final_filter(cases(spark, sf_dir), "1996-01-01", "1998-12-31").select("case_id")


@query(f"with {_C} select count(*) filter (where victim_outcome = 'survived') as non_fatal_excluded, count(*) filter (where victim_outcome is distinct from 'survived') as cases_exported from c")
def non_fatal(spark, sf_dir):
    return selection.exclude_survived(cases(spark, sf_dir))[1]


@query("""select o_orderkey, coalesce(o_orderdate::date between date '1997-01-01' and date '1997-12-31', false) or coalesce(bool_or(l_shipdate::date between date '1997-01-01' and date '1997-12-31'), false) as inside from orders left join lineitem on o_orderkey = l_orderkey group by o_orderkey, o_orderdate""")
def any_in_window(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_shipdate").cast("date")).alias("more"))
    met = table(spark, sf_dir, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return met.select("o_orderkey", selection.any_in_window(F.col("o_orderdate").cast("date"), F.col("more"), "1997-01-01", "1997-12-31").alias("inside"))


@query(f"""with {_C}, p as (select n_name from nation) select case_id, case when city is null then 'city:unverified' else '' end as flags from c where city is null or lower(city) = 'nation_3'""")
def strict_city(spark, sf_dir):
    rows = cases(spark, sf_dir).withColumn("flags", F.array().cast("array<string>"))
    return selection.place_filter(rows, places(spark, sf_dir), "city", "NATION_3").select("case_id", F.array_join("flags", ",").alias("flags"))


@query(f"""with {_C}, d as (select case_id, coalesce(incident_date, death_date) as x from c) select case_id, case when x is null then 'date:unverified' else '' end as flags from d where x is null or x between date '1996-01-01' and date '1996-12-31'""")
def strict_date(spark, sf_dir):
    rows = cases(spark, sf_dir).withColumn("flags", F.array().cast("array<string>"))
    return cleanup.strict_dates(rows, "1996-01-01", "1996-12-31").select("case_id", F.array_join("flags", ",").alias("flags"))


@query(f"""with {_C} select case_id, case when confidence_score < 0.4 then 'low_confidence' when coalesce(incident_geography, '') not in ('israel_arab_society', '') then 'bad_geography'
 when victim_name is null and victim_name_ar is null and victim_name_he is null and victim_name_en is null then 'no_name' when victim_outcome is distinct from 'died' then 'not_died' else 'rollup_only_single_source' end as category from c
 where confidence_score < 0.4 or coalesce(incident_geography, '') not in ('israel_arab_society', '') or (victim_name is null and victim_name_ar is null and victim_name_he is null and victim_name_en is null) or victim_outcome is distinct from 'died' or ({_N} = 1 and case_id % 11 = 0)""")
def outliers(spark, sf_dir):
    return selection.outliers(file(spark, sf_dir)).select("case_id", "category")


@query(f"with {_C} select case_id, array_to_string(list_filter(case when case_id % 3 = 0 then [part_name || ' senior', segment] else [] end, lambda a: victim_name is not null and a is not null and len(list_intersect(string_split(lower(a), ' '), string_split(lower(victim_name), ' '))) > 0), '|') as aliases from c")
def alias_filter(spark, sf_dir):
    return file(spark, sf_dir).select("case_id", F.array_join(cleanup.drop_weak_aliases(F.col("aliases"), F.col("victim_name")), "|").alias("aliases"))


_NAMES2 = "n as (select conv_id, string_split(text, ' ')[1] || ' ' || string_split(text, ' ')[2] as name from conversations where turn = 0)"


@query(f"""with {_NAMES2}, k as (select conv_id, name, case when length(string_split(name, ' ')[2]) >= 4 then string_split(name, ' ')[2] end as last from n where name is not null and not contains(name, chr(10)))
select conv_id as case_id, turn::varchar as url from conversations join k using (conv_id) where coalesce(text, '') = '' or contains(text, name) or contains(text, last)""")
def decontaminate(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("case_id"), "turn", "text")
    words = F.split("text", " ")
    named = talks.where("turn = 0").select("case_id", F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1))).alias("_n"), (F.size(words) > 1).alias("_two")).where("_two and not contains(_n, '\n')").select("case_id", F.array("_n").alias("names"))
    keyed = talks.select("case_id", F.concat_ws("#", "case_id", "turn").alias("url"), "text")
    kept = selection.decontaminate(named, keyed.select("case_id", "url"), keyed.select("url", "text"))
    return kept.select("case_id", F.substring_index("url", "#", -1).alias("url"))


@query(f"""with {_C} select case_id from c where {_N} = 1 and case_id % 2 = 0""")
def injury_titles(spark, sf_dir):
    f = file(spark, sf_dir)
    titles = f.select(F.explode("sources").alias("s"), "case_id").select("s.url", F.when(F.col("case_id") % 2 == 0, V.INJURY_MARKERS[0]).otherwise("calm").alias("title")).dropDuplicates(["url"])
    return selection.injury_only(f, titles).select("case_id")


@query(f"""with {_C} select case_id, city, district, weapon_type, {_N}::int as source_count, (case_id % 6)::int as media_count, {_FLAGS} as flags from c""")
def case_summary(spark, sf_dir):
    rows = selection.case_summary(file(spark, sf_dir).withColumn("canonical_case_id", F.col("case_id").cast("string")))
    return rows.select(F.col("canonical_case_id").cast("long").alias("case_id"), "city", "district", "weapon_type", "source_count", "media_count", F.array_join("flags", ",").alias("flags"))


@query(f"""with {_C} select case_id from c where contains(lower(coalesce(city, '')), 'nation_1') and victim_outcome = 'died' and contains(lower(coalesce(victim_name, '')), 'ring') and confidence_score >= 0.2
 and (incident_date is null or incident_date between date '1995-06-01' and date '1999-06-01') and {_FLAGS} <> '' and coalesce(victim_name, '') <> ''""")
def list_cases(spark, sf_dir):
    summary = selection.case_summary(file(spark, sf_dir).withColumn("canonical_case_id", F.col("case_id").cast("string")).withColumn("victim_name_ar", F.lit(None).cast("string")).withColumn("victim_name_he", F.lit(None).cast("string")))
    found = selection.list_filter(summary, city="nation_1", outcome="died", search="RING", min_confidence=0.2, date_from="1995-06-01", date_to="1999-06-01", flagged=True)
    return found.select(F.col("canonical_case_id").cast("long").alias("case_id"))


@query(f"""with {_C} select case_id, (select count(*) from c c2 where c2.victim_outcome = 'died')::bigint as total from c where victim_outcome = 'died' order by incident_date desc nulls first, case_id limit 40 offset 40""")
def case_page(spark, sf_dir):
    died = cases(spark, sf_dir).where("victim_outcome = 'died'")
    one = tables.page(died, 2, 40, *tables.sort_keys("incident_date", True, "case_id"))
    return one.select("case_id").join(F.broadcast(died.agg(F.count("*").alias("total"))))


@query(f"""with {_C} select case_id from c where year(incident_date) = 1997 and (contains(lower(coalesce(victim_name_en, '')), 'red') or contains(coalesce(victim_name_ar, ''), 'red'))""")
def ui_search(spark, sf_dir):
    return selection.ui_filter(cases(spark, sf_dir), "current-year", 1997, " Red ").select("case_id")


@query(f"""with {_C}, s as (select case_id, unnest(range(1, {_N} + 1)) as i from c), h as (select c.case_id, {_N} as n, coalesce(bool_or(i % 2 = 0), false) as ar, coalesce(bool_or(i = 4), false) as pay, coalesce(bool_or(i = 2), false) as cut from c left join s using (case_id) group by 1, 2)
select case_id, ar as has_arabic, case_id % 6 = 0 as no_media, pay as premium, cut as cut_body from h""")
def coverage_flags(spark, sf_dir):
    out = selection.coverage_flags(file(spark, sf_dir))
    has = lambda f: F.array_contains("flags", f)
    return out.select("case_id", (~has("needs_arabic_sources")).alias("has_arabic"), has("needs_media_extraction").alias("no_media"), has("premium_source").alias("premium"), has("needs_full_body_source").alias("cut_body"))


@query("""select doc_id, contains(lower(text), 'the') and contains(lower(text), 'tion') as hit from documents""")
def term_match(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", selection.all_terms(F.col("text"), "The TION").alias("hit"))


# --- URLs, HTML, feeds ---------------------------------------------------------------------

_REGISTRY = {1: {"example.com": "Com"}, 2: {"example.org": "Org"}, 3: {"example.net": "Net"}}
_HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '')"


@query(rf"""select page_id, h as host, case when h like '%.example.com' or h = 'example.com' then 1 when h like '%.example.org' or h = 'example.org' then 2 when (h like '%.example.net' or h = 'example.net') and contains(lower(url), '/en/') and not contains(lower(url), '#top') then 3 end as tier,
case when h like '%example.com' then 'Com' when h like '%example.org' then 'Org' when h like '%example.net' then 'Net' end as publisher from (select *, {_HOST} as h from pages)""")
def url_classify(spark, sf_dir):
    found = urls.classify(F.col("url"), _REGISTRY, ("/en/",), ("#top",))
    return table(spark, sf_dir, "pages").select("page_id", text.host(F.col("url")).alias("host"), F.explode(F.array(found)).alias("f")).select("page_id", "host", "f.tier", "f.publisher")


@query(rf"""select publisher, count(*) as n from (select upper(left(p, 1)) || substr(p, 2) as publisher from (select string_split({_HOST}, '.')[1] as p from pages)) group by publisher""")
def host_publisher(spark, sf_dir):
    return tables.histogram(table(spark, sf_dir, "pages").select(text.publisher(F.col("url")).alias("publisher")), "publisher")


@query("""select page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) as title, regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) as lang, len(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) as n_links, url as og_image, 'Alt ' || page_id as og_alt from pages""")
def html_meta(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("html", F.concat(F.lit('<meta property="og:image" content="'), F.col("url"), F.lit('"/><meta property="og:image:alt" content="Alt '), F.col("page_id").cast("string"), F.lit('"/>'), F.col("html")))
    h = F.col("html")
    made = pages.select("page_id", html.title(h).alias("title"), html.language(h).alias("lang"), F.size(html.links(h)).cast("long").alias("n_links"), F.explode(html.meta_images(h)).alias("m"))
    return made.select("page_id", "title", "lang", "n_links", F.col("m.url").alias("og_image"), F.col("m.alt").alias("og_alt"))


@query(r"""with a as (select page_id, url, html, regexp_extract(html, '(?s)<article(?:\s[^>]*)?>(.*?)</article>', 1) as inner_html from pages),
t as (select *, trim(regexp_replace(regexp_replace(regexp_replace(inner_html, '(?s)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g')) as body from a)
select page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) as title, md5(body) as body_md5, case when len(string_split(body, ' ')) < 50 then 'non_article' when contains(lower(body), 'subscribe') or contains(lower(body), 'premium') then 'partial' else 'article' end as content_type from t where body <> ''""")
def article_extract(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").where("html like '%<article%'")
    keyed = pages.withColumn("url", F.col("page_id").cast("string"))
    out = connectors.article(keyed.where(html.clean_text(html.element(F.col("html"), "article")) != ""))
    return out.select(F.col("url").cast("long").alias("page_id"), "title", F.md5("body").alias("body_md5"), "content_type")


@query(rf"""select page_id from pages where {_HOST} not like '%.example.net' or regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) not like '/en%'""")
def robots_gate(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    robots = pages.select(text.host(F.col("url")).alias("host")).distinct().where("host like '%.example.net'").withColumn("body", F.lit("User-agent: *\nDisallow: /en"))
    return connectors.can_fetch(pages, robots).select("page_id")


@query("""select event_type, window_start, count(*) as n from (select event_type, make_timestamp((floor(epoch(ts) / 172800) * 172800000000)::bigint) as window_start from events) group by all""")
def windows_48h(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return windowed_counts(events, "ts", ["event_type"]).select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


# --- names ---------------------------------------------------------------------------------

_PAIR = """p as (select a.p_partkey as id_a, b.p_partkey as id_b, a.p_name as x, b.p_name as y, string_split(a.p_name, ' ') as xs, string_split(b.p_name, ' ') as ys from part a join part b on a.p_brand = b.p_brand and a.p_size = b.p_size and a.p_partkey < b.p_partkey)"""


def _pairs(spark, sf_dir, compare):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.array(F.concat_ws("|", "p_brand", F.col("p_size").cast("string"))).alias("keys"))
    return pairs.compared(part, "keys", ["name"], lambda a, b: compare(a["name"], b["name"]))


@query(f"with {_PAIR} select id_a, id_b, round(greatest(jaro_winkler_similarity(x, y), jaro_winkler_similarity(x, ys[2]), jaro_winkler_similarity(xs[1], y), jaro_winkler_similarity(xs[1], ys[2])), 4) as best from p")
def best_names(spark, sf_dir):
    word = lambda c, i: F.get(F.split(c, " "), F.lit(i))
    best = lambda x, y: F.round(names.best_jaro(F.array(x, word(x, 0)), F.array(y, word(y, 1))), 4)
    return _pairs(spark, sf_dir, best).withColumnRenamed("result", "best")


_JW = "jaro_winkler_similarity({}, {}) >= 0.85"


@query(f"""with {_PAIR}, q as (select *, [ys[1], 'bin', ys[2]] as zs from p) select id_a, id_b, ({' or '.join(_JW.format('xs[1]', f'zs[{i}]') for i in (1, 2, 3))}) and ({' or '.join(_JW.format('xs[2]', f'zs[{i}]') for i in (1, 2, 3))})
 and {_JW.format('xs[1]', 'zs[1]')} and {_JW.format('xs[2]', 'zs[3]')} as inside from q""")
def name_containment(spark, sf_dir):
    word = lambda c, i: F.get(F.split(c, " "), F.lit(i))
    longer = lambda y: F.concat_ws(" ", word(y, 0), F.lit("bin"), word(y, 1))
    return _pairs(spark, sf_dir, lambda x, y: names.contained(F.array(x), F.array(longer(y)))).withColumnRenamed("result", "inside")


_M = "jaro_winkler_similarity(xs[{}], ys[{}]) >= 0.72 or xs[{}] = ys[{}]"


@query(f"""with {_PAIR}, m as (select *, {_M.format(1, 1, 1, 1)} as a, {_M.format(1, 2, 1, 2)} as b, {_M.format(2, 1, 2, 1)} as c, {_M.format(2, 2, 2, 2)} as d, jaro_winkler_similarity(x, y) as s from p),
n as (select *, case when a then 1 + d::int when b then 1 + c::int else (c or d)::int end as shared from m)
select id_a, id_b, x = y or s >= 0.88 or (shared >= 2 and a) as ok, case when x = y then 'name_exact' when s >= 0.88 then 'name_jaro' when shared >= 2 and a then 'name_shared_edge_tokens' else 'name_mismatch' end as reason from n""")
def name_compatible(spark, sf_dir):
    found = lambda x, y: F.struct(names.compatible(x, y)["ok"].alias("ok"), F.substring_index(names.compatible(x, y)["reason"], ":", 1).alias("reason"))
    return _pairs(spark, sf_dir, found).select("id_a", "id_b", "result.ok", "result.reason")


@query(f"""with {_PAIR}, m as (select *, jaro_winkler_similarity(x, y) as s, ({_JW.format('xs[1]', 'ys[1]')} or {_JW.format('xs[1]', 'ys[2]')})::int + ({_JW.format('xs[2]', 'ys[1]')} or {_JW.format('xs[2]', 'ys[2]')})::int as shared from p)
select id_a, id_b, s >= 0.95 or (s >= 0.85 and shared >= 2) as ok from m""")
def name_verified(spark, sf_dir):
    return _pairs(spark, sf_dir, lambda x, y: names.verified(F.array(x), F.array(y))).withColumnRenamed("result", "ok")


@query("""with k as (select p_partkey as id, ['nametok|' || left(t, 8) for t in string_split(p_name, ' ') if length(t) >= 5] as toks, case when p_size % 7 = 0 then '__no_block__' else lower(p_brand) || '|' || '2024-' || lpad((p_size % 12 + 1)::varchar, 2, '0') end as place, p_type from part),
e as (select distinct id, unnest(list_append(toks, place)) as key from k) select distinct a.id as id_a, b.id as id_b from e a join e b on a.key = b.key and a.id < b.id""")
def block_pairs(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    keys = pairs.block_keys(F.when(F.col("p_size") % 7 != 0, F.col("p_brand")), F.make_date(F.lit(2024), F.col("p_size") % 12 + 1, F.lit(1)), text.romanize(F.col("p_name")))
    return pairs.block_pairs(part.select(F.col("p_partkey").alias("id"), keys.alias("keys")), "keys")


def _he(c: str) -> str:
    pairs_ = [(k, v) for k, v in V.ARABIC_TO_HEBREW.items() if len(v) != 1]
    for k, v in pairs_:
        c = f"replace({c}, '{k}', '{v.replace(chr(39), chr(39) * 2)}')"
    single = {k: v for k, v in V.ARABIC_TO_HEBREW.items() if len(v) == 1}
    return f"translate({c}, '{''.join(single)}', '{''.join(single.values())}')"


@query(f"""with {_C} select victim_name_ar as name, count(*) as n, {_he('victim_name_ar')} as he, 'rule_based' as method from c where victim_name_ar is not null group by 1""")
def name_scripts(spark, sf_dir):
    made = cases(spark, sf_dir).where("victim_name_ar is not null").select(F.col("victim_name_ar").alias("name"), translit.transliterate(F.col("victim_name_ar"), "ar", "he").alias("t"))
    return made.groupBy("name").agg(F.count("*").alias("n"), F.max("t.value").alias("he"), F.max("t.method").alias("method"))


@query(f"""with {_C} select case_id, case when victim_name_ar is null and victim_name_he is not null then 1 else 0 end + case when victim_name_he is null and victim_name_ar is not null then 1 else 0 end + case when victim_name_en is null and (victim_name_ar is not null or victim_name_he is not null) then 1 else 0 end as n_made from c""")
def missing_scripts(spark, sf_dir):
    rows = cases(spark, sf_dir)
    made = translit.missing_scripts({s: F.col(f"victim_name_{s}") for s in ("ar", "he", "en")}, F.lit(None).cast(translit.KIND))
    return rows.select("case_id", F.size(made).alias("n_made"))


_ROMAN = "case victim_name_ar when 'محمد سالم' then 'MOHAMMED-SALEM' when 'بكر محمود ياسين' then 'BAKR-MAHMOUD-YASSIN' when 'بكر ياسين' then 'BAKR-YASSIN' when 'أحمد نصار' then 'AHMED-NASSAR' end"


@query(f"""with {_C}, p as (select case_id, left(coalesce(incident_date, death_date)::varchar, 4) as y, case when city is not null then regexp_replace(upper(city), '[^A-Z]', '', 'g') end as t,
 coalesce(regexp_replace(upper(replace(victim_name_en, ' ', '-')), '[^A-Z-]', '', 'g'), {_ROMAN}) as n from c where victim_name_en is not null or victim_name_ar is not null)
select case_id, case when (y is not null)::int + (t is not null)::int + (n is not null)::int >= 2 then array_to_string(list_filter(['IL', 'HOMICIDE', y, t, n], lambda x: x is not null), '-') else 'OLD' end as id from p""")
def case_ids(spark, sf_dir):
    made = translit.case_id(F.col("incident_date"), F.col("death_date"), F.col("city"), F.col("victim_name_en"), F.col("victim_name_ar"), F.col("victim_name_he"), F.lit("OLD"))
    return cases(spark, sf_dir).where("victim_name_en is not null or victim_name_ar is not null").select("case_id", made.alias("id"))


@query(f"""with {_C}, n as (select *, coalesce(victim_name_he, victim_name) as nm from c) select case_id, case when nm is not null then array_to_string(list_transform(['ynet.co.il', 'mako.co.il', 'haaretz.co.il', 'walla.co.il', 'israelhayom.co.il', 'n12.co.il'], lambda s: 'site:' || s || ' "' || nm || '"'), '|')
 when city is not null and incident_date is not null then '"' || city || '" רצח ' || year(incident_date) else '' end as queries from n""")
def tier_searches(spark, sf_dir):
    none = F.lit(None).cast("string")
    fields = {"he": F.coalesce("victim_name_he", "victim_name"), "ar": F.col("victim_name_ar"), "city": F.col("city"), "city_ar": none, "city_en": none, "year": F.year("incident_date")}
    return cases(spark, sf_dir).select("case_id", F.array_join(text.tier_queries(fields, "mainstream"), "|").alias("queries"))


# --- identity ------------------------------------------------------------------------------

_NEAR = f"""{_C}, q as (select a.case_id as id_a, b.case_id as id_b, a.city as city_a, b.city as city_b, a.incident_date as date_a, b.incident_date as date_b, abs(date_diff('day', a.incident_date, b.incident_date)) as gap from c a join c b on a.cust = b.cust and a.case_id < b.case_id)"""


def _near(spark, sf_dir):
    rows = cases(spark, sf_dir).select("case_id", "cust", "city", "incident_date", F.col("city").alias("place"))
    side = lambda s: rows.select(*[F.col(c).alias(f"{c}_{s}") for c in rows.columns])
    met = side("a").join(side("b"), (F.col("cust_a") == F.col("cust_b")) & (F.col("case_id_a") < F.col("case_id_b")))
    of = lambda s: {"city": F.col(f"city_{s}"), "place": F.col(f"place_{s}"), "date": F.col(f"incident_date_{s}")}
    return met, of("a"), of("b")


@query(f"""with {_NEAR} select id_a, id_b, case when city_a <> city_b then false when gap > 3 then false else city_a is not null or city_b is not null or date_a is not null or date_b is not null end as ok,
case when city_a <> city_b then 'city_mismatch' when gap > 3 then 'date_mismatch:' || gap || 'd' when city_a is not null or city_b is not null or date_a is not null or date_b is not null then 'city_date_match' else 'no_identity_signal' end as reason from q""")
def city_date_gate(spark, sf_dir):
    met, a, b = _near(spark, sf_dir)
    return met.select(F.col("case_id_a").alias("id_a"), F.col("case_id_b").alias("id_b"), identity.city_date_gate(a, b, False).alias("g")).select("id_a", "id_b", "g.ok", "g.reason")


@query(f"""with {_NEAR} select id_a, id_b, (id_a % 3 <> 0 and id_b % 3 <> 0 and id_a % 2 = id_b % 2 and not (coalesce(city_a <> city_b, false) and coalesce(gap > 30, false)))
 or (id_a % 3 = 0 and id_b % 3 = 0 and not coalesce(city_a <> city_b, false) and not coalesce(gap > 3, false) and (city_a is not null or city_b is not null or date_a is not null or date_b is not null)) as ok from q""")
def same_case(spark, sf_dir):
    met, a, b = _near(spark, sf_dir)
    name = lambda s: F.when(F.col(f"case_id_{s}") % 3 != 0, F.when(F.col(f"case_id_{s}") % 2 == 0, "alpha beta").otherwise("zzyx qqwv"))
    rule = identity.same_case(a | {"name": name("a"), "text": F.lit("")}, b | {"name": name("b"), "text": F.lit("")})
    return met.select(F.col("case_id_a").alias("id_a"), F.col("case_id_b").alias("id_b"), F.coalesce(rule["ok"], F.lit(False)).alias("ok"))


@query("""with li as (select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_suppkey) as l_suppkey, min(l_shipdate) as l_shipdate from lineitem group by 1, 2),
v as (select l_orderkey as article_id, l_linenumber as idx, 'alpha' || chr(97 + (l_partkey % 26)::int) || 'n beta' || chr(97 + (l_partkey % 26)::int) || 'm' as name, s_nationkey as town, l_shipdate::date as day from li join supplier on s_suppkey = l_suppkey),
f as (select article_id, town as t0, day as d0, name as n0 from v where idx = 1)
select v.article_id, idx from v join f using (article_id) where idx = 1 or town = t0 or abs(date_diff('day', day, d0)) <= 1 or contains(n0, string_split(name, ' ')[1]) and contains(n0, string_split(name, ' ')[2])""")
def weak_secondary(spark, sf_dir):
    letter = F.chr(97 + F.col("l_partkey") % 26)
    once = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_shipdate")])
    rows = once.join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    rows = rows.select(F.col("l_orderkey").alias("article_id"), (F.col("l_linenumber") - 1).alias("victim_index"), F.concat(F.lit("alpha"), letter, F.lit("n beta"), letter, F.lit("m")).alias("victim_name"), F.concat(F.lit("town"), F.col("s_nationkey").cast("string")).alias("city"), F.concat(F.lit("town"), F.col("s_nationkey").cast("string")).alias("place"), F.col("l_shipdate").cast("date").alias("incident_date"))
    page = rows.where("victim_index = 0").select("article_id", F.col("victim_name").alias("page")).dropDuplicates(["article_id"])
    kept = identity.drop_weak_secondary(rows.join(page, "article_id"))
    return kept.select("article_id", (F.col("victim_index") + 1).alias("idx"))


@query(f"""with {_NEAR} select id_a, id_b, case when city_b is not null and city_a is not null and city_a <> city_b then 'city_mismatch' when abs(date_diff('day', case when abs(year(date_b) - year(date_a)) >= 2 then coalesce(try_cast(printf('%04d-%s', year(date_a), strftime(date_b, '%m-%d')) as date), date_b) else date_b end, date_a)) > 30 then 'date_mismatch' else '' end as reason from q""")
def same_incident(spark, sf_dir):
    met, a, b = _near(spark, sf_dir)
    none = F.array().cast("array<string>")
    known = F.filter(F.array(a["city"]), lambda c: c.isNotNull())
    case = {"cities": known, "places": none, "names": none, "aliases": none, "date": a["date"]}
    new = {"city": b["city"], "place": F.lit(None).cast("string"), "name": F.lit(None).cast("string"), "date": b["date"]}
    # NATION_1 and NATION_2 are one word in Latin letters, so places are told apart by their own spelling here
    spelled = lambda c: F.translate(c, "0123456789", "abcdefghij")
    case["cities"], new["city"] = F.transform(known, spelled), spelled(b["city"])
    return met.select(F.col("case_id_a").alias("id_a"), F.col("case_id_b").alias("id_b"), F.substring_index(identity.same_incident(case, new)["reason"], ":", 1).alias("reason"))


@query(f"""with {_NEAR} select id_a, id_b from q where city_a = city_b and gap <= 10""")
def verify_rule(spark, sf_dir):
    met, a, b = _near(spark, sf_dir)
    none = {"names": F.array().cast("array<string>")}
    return met.where(identity.verify_match(a | none, b | none)).select(F.col("case_id_a").alias("id_a"), F.col("case_id_b").alias("id_b"))


# --- resolvers and folds -------------------------------------------------------------------


@query("""with v as (select user_id, event_id, floor(value)::int as age, event_type from events where event_type <> 'error'),
w as (select user_id, max(age) - min(age) > 40 as age_conflict, arg_min(age, event_id) filter (where event_type = 'signup') as t, arg_min(age, event_id) as f from v group by 1),
m as (select user_id, age from (select user_id, age, row_number() over (partition by user_id order by count(*) desc, min(event_id)) as rn from v group by 1, 2) where rn = 1)
select user_id, case when age_conflict then coalesce(t, f) else m.age end as age, age_conflict from w join m using (user_id)""")
def resolve_age(spark, sf_dir):
    rows = table(spark, sf_dir, "events").where("event_type <> 'error'").select("user_id", "event_id", F.floor("value").cast("int").alias("v"), "event_type")
    return resolve.age(rows, ["user_id"], "v", "event_type", "event_id", spread=40, trusted="signup")


@query("""select user_id, arg_max(s, case s when 'died' then 4 when 'critical' then 3 when 'survived' then 2 else 1 end) as outcome, count(distinct s) > 1 as regressed from (select user_id, case event_type when 'purchase' then 'died' when 'signup' then 'critical' when 'click' then 'survived' else 'unknown' end as s from events) group by 1""")
def resolve_outcome(spark, sf_dir):
    e = F.col("event_type")
    s = F.when(e == "purchase", "died").when(e == "signup", "critical").when(e == "click", "survived").otherwise("unknown")
    return table(spark, sf_dir, "events").withColumn("s", s).groupBy("user_id").agg(resolve.fatal_first(F.col("s")).alias("outcome"), resolve.regressed(F.col("s")).alias("regressed"))


@query("""select l_orderkey, arg_min(l_returnflag, (case l_returnflag when 'R' then 1 when 'A' then 2 else 3 end, l_linenumber)) as place, list(l_linestatus order by l_linenumber, l_linestatus)::varchar as statuses from lineitem group by 1""")
def resolve_places(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(resolve.most_specific(F.col("l_returnflag"), ["R", "A"], F.col("l_linenumber")).alias("place"), resolve.source_list(F.struct("l_linenumber", "l_linestatus"), "l_linestatus").alias("s"))
    return g.select("l_orderkey", "place", F.concat(F.lit("["), F.array_join(F.col("s.l_linestatus"), ", "), F.lit("]")).alias("statuses"))


@query("""with l as (select l_orderkey, l_returnflag, arg_max(l_linestatus, (l_linenumber, l_linestatus)) as v from lineitem group by 1, 2) select l_orderkey, string_agg(l_returnflag || '=' || v, ',' order by l_returnflag) as conflict from l group by 1 having count(distinct v) > 1""")
def conflict_maps(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("o", F.struct("l_linenumber", "l_linestatus"))
    out = resolve.conflict_map(rows, ["l_orderkey"], "l_returnflag", "l_linestatus", "o")
    return out.select("l_orderkey", F.array_join(F.transform(F.array_sort(F.map_entries("conflict")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("conflict"))


@query("""select l_orderkey, max(case when rn = 1 then y end)::int as year from (select l_orderkey, year(l_shipdate) as y, row_number() over (partition by l_orderkey order by count(*) desc, year(l_shipdate)) as rn from lineitem group by 1, 2) group by 1""")
def modal_year(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_shipdate").cast("date")).alias("d"))
    return g.select("l_orderkey", casefile.modal_year(F.col("d")).alias("year"))


@query(f"with {_C} select case_id, case when {_N} >= 1 then 'P1' else '' end as tier_1, case when {_N} >= 2 then 'P2' else '' end as tier_2, case when {_N} >= 3 then 'P3' else '' end as tier_3, case when {_N} >= 4 then 'P4' else '' end as untiered from c")
def tier_coverage(spark, sf_dir):
    made = file(spark, sf_dir).select("case_id", C.tier_coverage(F.col("sources")).alias("m"))
    return made.select("case_id", *[F.array_join(F.col("m")[t], ",").alias(t) for t in ("tier_1", "tier_2", "tier_3", "untiered")])


_SCORES = f"""s as (select case_id, {_N} as n, least(1.0::double, ((incident_date is not null)::int + (city is not null)::int + (case_id % 17 <> 0)::int) / 4.0::double + case when {_N} >= 2 then 0.1::double else 0 end) * case when case_id % 10 = 0 then 0.95::double else 1 end as a,
 ((victim_name_ar is not null)::int + (victim_name_he is not null)::int + (victim_name_en is not null)::int) / 3.0::double * 0.5::double + 1 / 4.0::double * 0.5::double as v0, victim_name_ar is not null and victim_name_he is not null as two, case when case_id % 3 = 0 then (part_name is not null)::int + (segment is not null)::int else 0 end as na,
 incident_date, death_date, case when case_id % 12 = 0 then day - 1 when case_id % 12 = 1 then day + 1 end as poss, ((city is not null)::int + (district is not null)::int) / 6.0::double as l0, case_id % 6 as m, case_id % 7 as ev from c),
t as (select *, coalesce(incident_date <= death_date, false) and coalesce(poss <= incident_date, true) as coh, ((incident_date is not null)::int + (death_date is not null)::int) / 3.0::double as t0 from s),
u as (select *, case when case_id % 4 = 0 and not coh then t0 * 0.6::double else t0 end as t1, least(1.0::double, v0 + case when two then 0.15::double else 0 end) as v1 from t),
w as (select *, case when poss is not null and not coh then t1 * 0.85::double else t1 end as t2, case when na >= 1 then least(1.0::double, v1 + 0.05::double * least(na, 3)) else v1 end as v2,
 case when m = 0 then 0.05::double when m = 1 then 0.4::double when m <= 3 then 0.7::double else least(1.0::double, 0.7::double + 0.05::double * (m - 3)) end as m0 from u)"""


@query(f"""with {_C}, {_SCORES}, x as (select case_id, round_even(a, 3) as case_identity, round_even(case when case_id % 15 = 0 then v2 * 0.9::double else v2 end, 3) as victim_identity, round_even(case when ev >= 4 then least(1.0::double, t2 + 0.15::double) else t2 end, 3) as timeline,
 round_even(case when n >= 3 then 0.1::double else 0.0::double end, 3) as legal, round_even(case when n >= 2 then l0 else least(l0, 0.7::double) end, 3) as location, round_even(case when case_id % 6 = 0 then least(m0, 0.3::double) else m0 end, 3) as media from w)
select *, round_even(round_even(case_identity * 0.25::double + victim_identity * 0.2::double + timeline * 0.15::double + legal * 0.15::double + location * 0.15::double + media * 0.1::double, 3), 3) as overall from x""")
def category_scores(spark, sf_dir):
    out = C.apply_scores(file(spark, sf_dir))
    return out.select("case_id", "confidence.*", F.col("confidence_score").alias("overall"))


_ORDERED = "k as (select *, row_number() over (partition by cust order by price desc, case_id) as rk from c)"


@query(f"""with {_C}, {_ORDERED} select cust, count(*) as n_merged, arg_min(victim_name_ar, rk) filter (where victim_name_ar is not null) as victim_name_ar, arg_min(city, rk) filter (where city is not null) as city,
 case when bool_or(victim_outcome = 'died') then 'died' when bool_or(victim_outcome = 'critical') then 'critical' when bool_or(victim_outcome = 'survived') then 'survived' end as victim_outcome, count(distinct victim_outcome) > 1 as outcome_conflict,
 (sum({_N}))::int as n_sources from k group by cust""")
def absorb_cases(spark, sf_dir):
    rows = file(spark, sf_dir).select("cust", "case_id", "price", "victim_name_ar", "city", "victim_outcome", "aliases", "flags", "sources", "confidence_score")
    out = absorb.absorb(rows, "cust", ["victim_name_ar", "city", "confidence_score"], {"sources": lambda s: s["url"]}, -F.col("price"), F.col("case_id"))
    return out.select("cust", "n_merged", "victim_name_ar", "city", "victim_outcome", F.array_contains("flags", "outcome_conflict").alias("outcome_conflict"), F.size("sources").alias("n_sources"))


@query("""with o as (select c_custkey as case_id, case when c_custkey % 3 = 0 then null else c_mktsegment end as segment from customer),
n as (select o_custkey as case_id, o_orderkey as seq, case when o_orderkey % 2 = 0 then 'BUILDING' else 'MACHINERY' end as v from orders),
f as (select case_id, arg_min(v, seq) as first_v from n group by 1)
select o.case_id, coalesce(segment, first_v) as segment, (select count(*) from n where n.case_id = o.case_id and n.v <> coalesce(segment, first_v)) as n_conflicts from o left join f on f.case_id = o.case_id""")
def merge_values(spark, sf_dir):
    own = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("case_id"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"))
    news = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("case_id"), F.col("o_orderkey").cast("string").alias("source"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 2 == 0, "BUILDING").otherwise("MACHINERY").alias("segment"))
    merged, conflicts = absorb.merge_values(own, news, ["segment"])
    n = conflicts.groupBy("case_id").agg(F.count("*").alias("n_conflicts"))
    return merged.join(n, "case_id", "left").select("case_id", "segment", F.coalesce("n_conflicts", F.lit(0)).alias("n_conflicts"))


_ONCE = "li as (select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_returnflag) as l_returnflag, min(l_linestatus) as l_linestatus from lineitem group by 1, 2)"


@query(f"""with {_ONCE} select l_orderkey as extraction_id, row_number() over (partition by l_orderkey order by l_linenumber) - 1 as victim_index, case when l_linenumber = 1 then 'first' else 'v' || l_partkey end as victim_name, case when l_linenumber = 1 then 'town' else nullif(l_linestatus, 'F') end as city, l_linenumber = 1 as has_aliases
 from li where l_linenumber = 1 or (l_linenumber > 1 and l_returnflag <> 'N' and l_orderkey in (select l_orderkey from li where l_linenumber = 1))""")
def virtual_records(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.min(c).alias(c) for c in ("l_partkey", "l_returnflag", "l_linestatus")])
    victim = F.struct(F.when(F.col("l_returnflag") != "N", F.concat(F.lit("v"), F.col("l_partkey").cast("string"))).alias("victim_name"), F.nullif("l_linestatus", F.lit("F")).alias("city"))
    more = lines.where("l_linenumber > 1").groupBy(F.col("l_orderkey").alias("_k")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", victim.alias("v")))).alias("_m"))
    base = lines.where("l_linenumber = 1").select(F.col("l_orderkey").alias("extraction_id"), F.lit("first").alias("victim_name"), F.lit("town").alias("city"), F.array(F.lit("alias")).alias("victim_aliases"))
    joined = base.join(more, F.col("extraction_id") == F.col("_k"), "left").withColumn("additional_victims", F.col("_m.v")).drop("_k", "_m")
    out = tables.virtual_records(joined, ["victim_name", "city"])
    return out.select("extraction_id", F.col("victim_index").cast("long").alias("victim_index"), "victim_name", "city", (F.size("victim_aliases") > 0).alias("has_aliases"))


# --- clean-up of case files ----------------------------------------------------------------


def case_file(spark, sf_dir) -> casefile.CaseFile:
    """The view with conflicts: a line of an order tells its own district, town, place of arrest, motive and name."""
    rows = file(spark, sf_dir).withColumns({
        "region": F.lit(None).cast("string"), "city_en": F.lit(None).cast("string"), "arrest_location": F.when(F.col("case_id") % 2 == 0, "flat"), "exact_place_type": F.lit("home"), "neighborhood": F.lit(None).cast("string"),
        "motive": F.lit("dispute"), "organized_crime": F.when(F.col("case_id") % 3 == 0, False).when(F.col("case_id") % 3 == 1, True), "police_status": F.lit("arrested"), "suspect_status": F.lit("in custody"), "legal_status": F.when(F.col("case_id") % 2 == 0, "indicted"),
        "police_investigation_status": F.lit(None).cast("string"), "rejected": F.array(F.struct(F.lit("u").alias("url"), F.concat(F.lit("city_mismatch: 'Old "), F.coalesce("city", F.lit("x")), F.lit("' vs")).alias("reason"), F.lit(None).cast("string").alias("reevaluated"))),
    })
    line = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    told = F.array(*[F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in {
        "district": F.when(n == 1, "גליל").when(n == 2, "Odd"), "city": F.when(n == 1, "NATION_1").when(n == 2, "old nation_3"),
        "arrest_location": F.when(n == 1, "a hidden flat in town").when(n == 2, "FLAT"), "exact_place_type": F.when(n == 1, "unknown").when(n == 3, "street corner"),
        "motive": F.when(n == 2, "family quarrel"), "victim_name": F.when(n == 1, "red senior").when(n == 2, "nobody"), "organized_crime": F.when(n == 4, "true"),
    }.items()])
    conflicts = line.select(F.col("l_orderkey").alias("case_id"), F.concat(F.lit("s"), n.cast("string")).alias("source"), F.explode(told).alias("t")).select("case_id", "t.field", "source", "t.value").where("value is not null").distinct()
    return casefile.CaseFile(rows, conflicts, places(spark, sf_dir).select("alias", "name_en", "district", "region"))


_L = "l as (select distinct l_orderkey as id, l_linenumber as n from lineitem), h as (select id, bool_or(n = 1) as l1, bool_or(n = 2) as l2, bool_or(n = 3) as l3, bool_or(n = 4) as l4 from l group by 1), f as (select c.*, coalesce(l1, false) as l1, coalesce(l2, false) as l2, coalesce(l3, false) as l3, coalesce(l4, false) as l4 from c left join h on id = case_id)"


@query(f"""with {_C}, {_L} select case_id, case district when 'צפון' then 'Northern District' when 'Northern' then 'Northern District' when 'Haifa' then 'Haifa District' else district end as district, case when district = 'גליל' or l1 then 'Galilee' end as region, l2::int as n_conflicts from f""")
def split_district(spark, sf_dir):
    out = casefile.split_district(case_file(spark, sf_dir))
    n = out.conflicts.where("field = 'district'").groupBy(F.col("case_id").alias("_c")).agg(F.count("*").cast("int").alias("n"))
    return out.cases.join(n, F.col("case_id") == F.col("_c"), "left").select("case_id", "district", "region", F.coalesce("n", F.lit(0)).alias("n_conflicts"))


@query(f"""with {_C} select case_id, victim_name_ar, case when victim_name_he = 'חסן abc' then null else victim_name_he end as victim_name_he, coalesce(victim_name_en, victim_name) as victim_name_en, coalesce(victim_name_he = 'חסן abc', false) as quarantined from c""")
def script_purity(spark, sf_dir):
    out = casefile.script_purity(case_file(spark, sf_dir)._replace(cases=file(spark, sf_dir).withColumn("flags", F.array().cast("array<string>")))).cases
    return out.select("case_id", "victim_name_ar", "victim_name_he", "victim_name_en", F.array_contains("flags", "mixed_script_name_quarantined").alias("quarantined"))


@query(f"""with {_C}, {_L}, a as (select *, list_concat(case when case_id % 3 = 0 then [part_name || ' senior', segment] else [] end, case when l1 then ['red senior'] else [] end, case when l2 then ['nobody'] else [] end) as al, list_filter([victim_name, victim_name_ar, victim_name_he, victim_name_en], lambda x: x is not null) as main from f)
select case_id, array_to_string(list_sort(list_distinct(list_filter(al, lambda x: x is not null and not list_contains(main, x) and len(list_intersect(string_split(x, ' '), list_filter(flatten([string_split(m, ' ') for m in main]), lambda t: length(t) >= 2))) > 0))), '|') as aliases from a""")
def promote_names(spark, sf_dir):
    return casefile.promote_names(case_file(spark, sf_dir)).cases.select("case_id", F.array_join(F.array_sort("aliases"), "|").alias("aliases"))


@query(f"""with {_C}, {_L} select case_id, case when l1 then 'a hidden flat in town' when l2 then 'FLAT' when case_id % 2 = 0 then 'flat' end as arrest_location, case when l3 then 'street corner' when l1 then 'unknown' else 'home' end as exact_place_type,
 case when l3 and l1 then 2 when l3 then 0 when l1 then 0 else 0 end::int as n_conflicts from f""")
def place_granularity(spark, sf_dir):
    out = casefile.resolve_places(case_file(spark, sf_dir))
    n = out.conflicts.where("field in ('arrest_location', 'exact_place_type')").groupBy(F.col("case_id").alias("_c")).agg(F.count("*").cast("int").alias("n"))
    return out.cases.join(n, F.col("case_id") == F.col("_c"), "left").select("case_id", "arrest_location", "exact_place_type", F.coalesce("n", F.lit(0)).alias("n_conflicts"))


@query(f"""with {_C}, {_L} select case_id, case when l2 then 'family quarrel' else '' end as motives, (l3::int) as n_places from f""")
def weak_conflicts(spark, sf_dir):
    out = casefile.weak_conflicts(case_file(spark, sf_dir))
    n = out.conflicts.where("field = 'exact_place_type'").groupBy(F.col("case_id").alias("_c")).agg(F.count("*").cast("int").alias("n"))
    return out.cases.join(n, F.col("case_id") == F.col("_c"), "left").select("case_id", F.array_join("motive_translations", "|").alias("motives"), F.coalesce("n", F.lit(0)).alias("n_places"))


@query(f"""with {_C}, {_L} select case_id, case when case_id % 3 = 1 then true when case_id % 3 = 0 and l4 then false end as organized_crime from f""")
def reset_booleans(spark, sf_dir):
    return casefile.reset_booleans(case_file(spark, sf_dir)).cases.select("case_id", "organized_crime")


@query(f"""with {_C}, {_L} select case_id, (l1 and coalesce(city, '') <> 'NATION_1')::int + (l2 and coalesce(city, '') <> 'NATION_3')::int as n_city from f where (l1 and coalesce(city, '') <> 'NATION_1') or (l2 and coalesce(city, '') <> 'NATION_3')""")
def clean_conflicts(spark, sf_dir):
    left = casefile.clean_conflicts(case_file(spark, sf_dir)).conflicts
    return left.where("field = 'city'").groupBy("case_id").agg(F.count("*").cast("int").alias("n_city"))


@query(f"""with {_C} select case_id, city as city_en, coalesce(nullif(district, ''), case when city is not null and c_nationkey % 2 = 0 then 'Northern District' end) as district, case when city is not null then region_name end as region from c join customer on c_custkey = cust""")
def city_resolution(spark, sf_dir):
    f = case_file(spark, sf_dir)
    return casefile.resolve_city(f).cases.join(table(spark, sf_dir, "customer").select("c_custkey"), F.col("c_custkey") == F.col("cust")).select("case_id", "city_en", "district", "region")


@query(f"""with {_C}, n as (select n_name, n_nationkey from nation) select case_id, case when city is not null and n_nationkey % 3 = 0 then 'would_now_match_gazetteer' end as reevaluated from c left join n on n_name = city""")
def reevaluate_rejected(spark, sf_dir):
    out = casefile.reevaluate_rejected(case_file(spark, sf_dir)).cases
    return out.select("case_id", F.get("rejected", F.lit(0))["reevaluated"].alias("reevaluated"))


@query(f"""with {_C} select case_id, {_N} - case when {_N} >= 3 and case_id % 2 = 0 then 1 else 0 end as n_sources, {_N} >= 3 and case_id % 2 = 0 as dropped from c""")
def drop_invalid(spark, sf_dir):
    out = casefile.drop_invalid_sources(case_file(spark, sf_dir)).cases
    return out.select("case_id", F.size("sources").cast("long").alias("n_sources"), F.array_contains("flags", "tier3_invalid_dropped").alias("dropped"))


@query(f"""with {_C}, s as (select case_id, unnest(range(1, {_N} + 1)) as i from c) select case_id, string_agg(case i when 1 then 'Ynet:1' when 2 then 'Arab48:2' when 3 then case when case_id % 2 = 0 then 'Israel Police:-' else 'Israel Police:3' end else 'Blog:-' end, ',' order by i) as sources from s group by 1""")
def normalise_sources(spark, sf_dir):
    out = casefile.normalise_sources(case_file(spark, sf_dir)).cases.where(F.size("sources") > 0)
    return out.select("case_id", F.array_join(F.transform("sources", lambda s: F.concat_ws(":", s["publisher"], F.coalesce(s["tier"].cast("string"), F.lit("-")))), ",").alias("sources"))


@query()
def sanity_pass(spark, sf_dir):
    out = casefile.sanity_pass(case_file(spark, sf_dir)).cases
    return out.select("case_id", "district", "region", "confidence_score", F.size("timeline").alias("n_events"), F.array_join(F.array_sort("flags"), ",").alias("flags"))


@query()
def quality_pass(spark, sf_dir):
    out = casefile.quality_pass(case_file(spark, sf_dir))
    n = out.conflicts.groupBy(F.col("case_id").alias("_c")).agg(F.count("*").alias("n_conflicts"))
    return out.cases.join(n, F.col("case_id") == F.col("_c"), "left").select("case_id", "canonical_case_id", "death_date", F.array_join("aliases", "|").alias("aliases"), F.coalesce("n_conflicts", F.lit(0)).alias("n_conflicts"))


@query("""select l_orderkey, l_linenumber, least(o_orderdate::date, l_shipdate::date) as incident_date, greatest(o_orderdate::date, l_shipdate::date) as death_date, o_orderdate::date > l_shipdate::date as swapped from lineitem join orders on l_orderkey = o_orderkey""")
def date_repair(spark, sf_dir):
    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = joined.select("l_orderkey", "l_linenumber", F.col("o_orderdate").cast("date").alias("incident_date"), F.col("l_shipdate").cast("date").alias("death_date"), F.lit(None).cast("date").alias("incident_date_possible"), F.array().cast("array<string>").alias("flags"))
    return cleanup.repair_dates(rows).select("l_orderkey", "l_linenumber", "incident_date", "death_date", (F.size("flags") > 0).alias("swapped"))


# --- media ---------------------------------------------------------------------------------


@query("""select doc_id, contains(lower(text), 'illustration') or contains(lower(text), 'stock photo') or contains(lower(text), 'file photo') or doc_id % 7 = 0 as is_stock, case when doc_id % 7 = 0 then 0.95 when contains(lower(text), 'illustration') or contains(lower(text), 'stock photo') or contains(lower(text), 'file photo') then 0.85 else 0.0 end::double as confidence from documents""")
def stock_signal(spark, sf_dir):
    url = F.when(F.col("doc_id") % 7 == 0, "https://media.GettyImages.com/x").otherwise("https://example.com/x")
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(captions.stock_signal(url, F.lower("text")))).alias("s")).select("doc_id", "s.is_stock", "s.confidence")


@query(f"""with t as (select doc_id, lower(text) as t from documents), p as (select *, string_split(t, 'thor') as parts from t),
n as (select *, len(list_filter(range(1, len(parts)), lambda i: not regexp_matches(right(array_to_string(parts[1:i], 'thor'), 50), '{V.CREDIT}'))) > 0 as named from p)
select doc_id, case when named then 'victim_portrait' else 'other' end as category, case when coalesce(t, '') = '' then 0.2 when named then 0.92 else 0.3 end::double as confidence from n""")
def caption_class(spark, sf_dir):
    """Captions: documents, whose class is a victim's portrait if they name Thor other than in a credit."""
    made = captions.keyword_class(F.lower("text"), F.array(F.lit("Thor")), F.array(F.lit("")), {"weapon": ["#no such word#"]})
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(made)).alias("k")).select("doc_id", "k.category", "k.confidence")


@query("""select doc_id, case when (contains(t, 'killed') or doc_id % 4 = 0) and not (contains(t, 'thedan') and contains(t, 'onre')) then 'caption_names_other_victim' when doc_id % 3 = 0 and not contains(t, 'ntation') then 'caption_mentions_other_location' end as reason from (select doc_id, lower(text) as t from documents where not contains(lower(text), 'victim') and not contains(lower(text), 'deceased') and text <> '')""")
def caption_mismatch(spark, sf_dir):
    """Captions: documents, every fourth with a word for a victim, every third with one for a scene."""
    docs = table(spark, sf_dir, "documents").where("not contains(lower(text), 'victim') and not contains(lower(text), 'deceased') and text <> ''")
    caption = F.concat("text", F.when(F.col("doc_id") % 4 == 0, " killed").otherwise(""), F.when(F.col("doc_id") % 3 == 0, " crime scene").otherwise(""))
    return docs.select("doc_id", captions.mismatch(caption, F.array(F.lit("Thedan Onre")), F.array().cast("array<string>"), F.array(F.lit("Ntation"))).alias("reason"))


@query("""with i as (select l_orderkey as article, 'https://x.org/' || case when l_partkey % 5 = 0 then 'icons/' else '' end || (l_partkey % 9) as url, l_linenumber as pos from lineitem), u as (select article, url, min(pos) as pos from i where not contains(url, '/icons/') group by 1, 2)
select article, url from (select *, row_number() over (partition by article order by pos, url) as rn from u) where rn <= 3""")
def media_candidates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("article_url"), F.concat(F.lit("https://x.org/"), F.when(F.col("l_partkey") % 5 == 0, "icons/").otherwise(""), (F.col("l_partkey") % 9).cast("string")).alias("source_url"), F.col("l_linenumber").alias("pos"))
    return gallery.first_per_article(rows, 3).select(F.col("article_url").alias("article"), F.col("source_url").alias("url"))


@query("""with i as (select l_orderkey % 50 as case_id, l_orderkey as article, l_linenumber as pos, l_orderkey * 10 + l_linenumber as k, case when l_partkey % 4 = 0 then null else (l_partkey % 3)::varchar end as sha, l_returnflag = 'A' as cap from lineitem)
select k from (select *, case when sha is null then 1 else row_number() over (partition by case_id, article, sha order by cap desc, pos, k) end as rn from i) where rn = 1""")
def once_per_article(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 50).alias("case_id"), F.col("l_orderkey").alias("article_url"), F.col("l_linenumber").alias("pos"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("media_key"),
        F.when(F.col("l_partkey") % 4 != 0, (F.col("l_partkey") % 3).cast("string")).alias("sha256"), F.when(F.col("l_returnflag") == "A", "c").alias("caption"), F.lit(None).cast("string").alias("figcaption"),
    )
    return gallery.once_per_article(rows).select(F.col("media_key").alias("k"))


def _gallery(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    return docs.select(
        (k % 200).alias("case_id"), k.alias("media_key"), F.concat(F.lit("https://"), "source", F.lit(".org/"), (k % 400).cast("string")).alias("article_url"), F.concat(F.lit("https://img.org/"), k.cast("string")).alias("source_url"),
        F.lit(None).cast("string").alias("figcaption"), F.when(k % 3 == 0, "a photo of Thedan Onre").when(k % 3 == 1, "crime scene").alias("caption"), F.lit(None).cast("string").alias("alt_text"), F.when(k % 5 == 0, "meta:og:image").otherwise("figure").alias("selector"),
        F.when(k % 4 == 0, "crime_scene").when(k % 4 == 1, "other").when(k % 4 == 2, "generic_stock").otherwise("funeral").alias("category"), F.lit(0.5).alias("confidence"), F.lit(False).alias("is_stock"), F.lit(0.0).alias("stock_confidence"),
        F.lit(100).alias("width"), F.lit(100).alias("height"), F.sha2("text", 256).alias("sha256"), F.substring(F.md5("text"), 1, 16).alias("phash"), k.alias("pos"),
    )


@query()
def gallery_finalize(spark, sf_dir):
    context = table(spark, sf_dir, "documents").select((F.col("doc_id") % 200).alias("case_id")).distinct().select("case_id", F.array(F.lit("Thedan Onre")).alias("victims"), F.array().cast("array<string>").alias("suspects"), F.array(F.lit("Ntation")).alias("cities"))
    return gallery.finalize(_gallery(spark, sf_dir), context).select("case_id", "media_id", "type", "is_evidence", "evidence_reason", "appearance_count")


@query("""with p as (select doc_id, doc_id % 100 as case_id, case doc_id % 4 when 0 then 'crime_scene' when 1 then 'weapon' when 2 then 'other' else 'funeral' end as type, doc_id % 9 = 0 as ev, case when doc_id % 2 = 0 then 'in ntation' else '' end as t from documents),
k as (select * from p where (ev or type <> 'other') and not (type = 'crime_scene' and t <> '' and not contains(t, 'ntation'))),
a as (select *, row_number() over (partition by case_id, type order by doc_id) as ra from k) select doc_id from (select *, row_number() over (partition by case_id order by doc_id) as rb from a where ra <= 2) where rb <= 8""")
def case_photos(spark, sf_dir):
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(
        k, (k % 100).alias("case_id"), F.concat(F.lit("u"), k.cast("string")).alias("primary_url"), F.when(k % 4 == 0, "crime_scene").when(k % 4 == 1, "weapon").when(k % 4 == 2, "other").otherwise("funeral").alias("type"), (k % 9 == 0).alias("is_evidence"),
        F.when(k % 2 == 0, "in ntation").otherwise("").alias("text"), F.lit("keyword").alias("classifier_tier"), F.lit(0.5).alias("confidence"), k.alias("pos"), F.array(F.lit("onre")).alias("surnames"), F.array(F.lit("ntation")).alias("city_tokens"),
    )
    return selection.photos(rows).select("doc_id")


# --- scans, exports, views -----------------------------------------------------------------


def _articles(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    return docs.select(k.alias("id"), F.when(k % 5 == 0, "blocked").otherwise("success").alias("fetch_status"), F.when(k % 3 == 0, "no").when(k % 3 == 1, "yes").otherwise("maybe").alias("triage_status"), F.col("text").alias("article_text"), k.alias("fetched_at"), F.col("source").alias("pipeline_run_id"))


def _records(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    n = table(spark, sf_dir, "documents").agg(F.count("*").alias("_n"))
    return e.join(F.broadcast(n)).select(F.col("event_id").alias("id"), (F.col("event_id") % F.col("_n")).alias("article_id"), F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("extraction_status"), F.col("ts").alias("extracted_at"))


_REC = "r as (select event_id as id, event_id % (select count(*) from documents) as article_id, event_type <> 'error' as ok, ts from events)"


@query(f"""with {_REC}, g as (select * from (select *, row_number() over (partition by article_id order by ts desc, id desc) as rn from r where ok) where rn = 1) select id, article_id from g join documents on doc_id = article_id where doc_id % 5 <> 0 and doc_id % 3 <> 0""")
def universe(spark, sf_dir):
    return scans.universe(_articles(spark, sf_dir), _records(spark, sf_dir)).select("id", "article_id")


@query("""select doc_id as id from documents where doc_id % 5 <> 0 and doc_id % 3 <> 0 and length(text) > 200""")
def reextract_scan(spark, sf_dir):
    return scans.to_reextract(_articles(spark, sf_dir)).select("id")


@query("""select doc_id as id, source as pipeline_run_id from documents where doc_id % 5 = 0 and source like 'src1%'""")
def articles_scan(spark, sf_dir):
    return scans.articles_by_status(_articles(spark, sf_dir), "blocked", "src1*").select("id", "pipeline_run_id")


@query(f"""with {_REC} select id, article_id from r join documents on doc_id = article_id where source = 'src2'""")
def run_extractions(spark, sf_dir):
    return scans.extractions(_records(spark, sf_dir), _articles(spark, sf_dir), "src2").select("id", "article_id")


@query(f"""with {_C}, o as (select case_id, row_number() over (order by coalesce(incident_date::varchar, '9999-99-99'), coalesce(victim_name_ar, victim_name_he, victim_name_en, victim_name, ''), case_id) - 1 as place from c) select case_id, place from o""")
def export_order(spark, sf_dir):
    rows = cases(spark, sf_dir)
    return tables.numbered(rows.select("case_id", "incident_date", "victim_name", "victim_name_ar", "victim_name_he", "victim_name_en"), "place", *exports.canonical_order(rows)).select("case_id", "place")


@query(f"""with {_C} select 0 as section, 0::bigint as line, '2.0' as version, count(*) filter (where victim_outcome is distinct from 'survived')::bigint as n, null::varchar as city from c
union all select 1, case_id, null, null, city from c where victim_outcome is distinct from 'survived' union all select 2, 0, null, count(*), null from c where review_status = 'P'""")
def envelope(spark, sf_dir):
    rows = cases(spark, sf_dir).select("case_id", "city", "victim_outcome", "victim_age", "review_status")
    review = rows.where("review_status = 'P'").select("case_id", F.lit("review").alias("decision"))
    lines = exports.envelope(rows, exports.case_stats(rows), review, "canonical_1")
    got = lines.select("section", "line", F.get_json_object("json", "$.schema_version").alias("version"), F.get_json_object("json", "$.case_count").cast("long").alias("n"), F.get_json_object("json", "$.city").alias("city"))
    pairs_ = got.where("section = 2").groupBy("section").agg(F.count("*").alias("n")).select("section", F.lit(0).cast("long").alias("line"), F.lit(None).cast("string").alias("version"), "n", F.lit(None).cast("string").alias("city"))
    return got.where("section < 2").unionByName(pairs_)


_MEM = f"m as (select c.*, n_nationkey as nk from c left join nation on n_name = city where victim_outcome = 'died')"


@query(f"""with {_C}, {_MEM} select city as locality, count(*) as death_count, max(incident_date) as most_recent_incident_date from m where nk is not null and nk <> 5 and coalesce(year(incident_date) >= 1996, true) group by 1""")
def memorial_rollup(spark, sf_dir):
    return exports.memorial(cases(spark, sf_dir), places(spark, sf_dir), 1996)[0].select("locality", "death_count", "most_recent_incident_date")


@query(f"""with {_C}, {_MEM} select count(*) as documented_deaths, count(*) filter (where nk is not null and nk <> 5) as total_deaths, count(*) filter (where nk is null or nk = 5) as unresolved_count, round_even(count(*) filter (where victim_age < 40) / count(victim_age) * 100, 0)::int as under_40_pct from m""")
def memorial_totals(spark, sf_dir):
    return exports.memorial(cases(spark, sf_dir), places(spark, sf_dir))[1].select("documented_deaths", "total_deaths", "unresolved_count", "under_40_pct")


@query(f"with {_C} select year(incident_date)::int as year, count(*) as n from c where incident_date is not null group by 1")
def year_counts(spark, sf_dir):
    return exports.year_counts(cases(spark, sf_dir))


@query(f"with {_C} select incident_geography, count(*) as n from c group by 1")
def geography_counts(spark, sf_dir):
    return exports.most_common(cases(spark, sf_dir), "incident_geography")


@query("""with t as (select case n_nationkey % 5 when 0 then 'galilee' when 1 then 'triangle' when 2 then 'negev' when 3 then 'mixed' end as region from customer join nation on c_nationkey = n_nationkey) select region, count(*) as n from t where region is not null group by 1""")
def region_counts(spark, sf_dir):
    met = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    town = F.element_at(F.array(*[F.lit(t) for t in ("Arraba", "Tira", "Rahat", "Lod", "Elsewhere")]), (F.col("n_nationkey") % 5 + 1).cast("int"))
    return exports.region_counts(met.select(exports.town_region(town).alias("region")))


@query("""select o_orderdate::date::varchar as day, count(*) as n, day(o_orderdate) || ' ' || ['يناير', 'فبراير', 'مارس', 'أبريل', 'مايو', 'يونيو', 'يوليو', 'أغسطس', 'سبتمبر', 'أكتوبر', 'نوفمبر', 'ديسمبر'][month(o_orderdate)] || ' ' || year(o_orderdate) as shown from orders group by 1, 3""")
def shown_dates(spark, sf_dir):
    day = F.col("o_orderdate").cast("date").cast("string")
    return table(spark, sf_dir, "orders").select(day.alias("day"), exports.shown_date(day).alias("shown")).groupBy("day", "shown").agg(F.count("*").alias("n"))


@query("""select doc_id as id, case when doc_id % 2 = 0 and doc_id % 3 = 1 then '' else md5(text) end as html from documents""")
def reclaim_html(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.md5("text").alias("raw_html"), F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 3).cast("int").alias("media_harvest_version"))
    return exports.reclaim(rows, 1).select("id", F.col("raw_html").alias("html"))


@query("""select doc_id as id, case when quality = 1 then 'success' else 'failed' end as status, case when quality = 1 then lang else '{}' end as json from documents left join labels using (doc_id)""")
def sentinel_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select(F.col("doc_id").alias("id"), F.col("lang").alias("extracted_json"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("_ok"))
    return exports.with_sentinels(docs, F.col("_ok")).select("id", F.col("extraction_status").alias("status"), F.col("extracted_json").alias("json"))


@query(f"""with {_PAIR} select sha256(least(id_a, id_b)::varchar || '|' || greatest(id_a, id_b)::varchar) as id, case when jaro_winkler_similarity(x, y) >= 0.9 then 'merge' else 'review' end as decision from p""")
def edge_store(spark, sf_dir):
    rows = _pairs(spark, sf_dir, names.jw).select(F.col("id_a").alias("record_a_id"), F.col("id_b").alias("record_b_id"), F.col("result").alias("jaro_score"), F.lit(0.0).alias("cosine_score"), F.lit("k").alias("block_key"))
    return exports.edge_rows(rows.withColumn("decision", F.when(F.col("jaro_score") >= 0.9, "merge").otherwise("review"))).select("id", "decision")


@query("""with o as (select l_orderkey as id, count(*) as n from lineitem where l_returnflag <> 'N' group by 1), w as (select l_orderkey as id, count(*) filter (where l_returnflag <> 'N' or l_linestatus = 'O') as n from lineitem group by 1) select w.id as article_id from w join o on o.id = w.id where w.n > o.n""")
def rollup_growth(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    grouped = lambda df: df.groupBy(F.col("l_orderkey").alias("article_id")).agg(F.collect_list(F.struct("l_linenumber")).alias("additional_victims"))
    old = grouped(line.where("l_returnflag <> 'N'")).withColumn("extracted_at", F.lit(1))
    return exports.grown_rollups(old, grouped(line.where("l_returnflag <> 'N' or l_linestatus = 'O'"))).select("article_id")


@query("""select n_name as name_en, coalesce(case when n_nationkey % 2 = 0 then 1.5 end, n_nationkey + 0.5)::double as lat from nation union all select 'NEW', 2.5::double""")
def place_store(spark, sf_dir):
    known = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name_en"), F.when(F.col("n_nationkey") % 2 == 0, 1.5).alias("lat"), F.lit(None).cast("double").alias("lng"))
    new = spark.createDataFrame([("NEW", 2.5, 1.0), ("NATION_1", 9.9, 9.9)], "name_en string, lat double, lng double")
    found = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name_en"), (F.col("n_nationkey") + 0.5).alias("lat"), F.lit(1.0).alias("lng"))
    return exports.patch_coordinates(exports.add_places(known, new), found).select("name_en", "lat")


# --- stages --------------------------------------------------------------------------------


@query()
def dedup_stage(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("_v"), F.col("embedding").alias("vector"))
    k = F.col("page_id")
    pages = table(spark, sf_dir, "pages").select(k.alias("id"), k.alias("article_id"), html.title(F.col("html")).alias("name"), text.host(F.col("url")).alias("city"), F.make_date(F.lit(2024), k % 12 + 1, k % 28 + 1).alias("incident_date"))
    return stages.dedup(pages.join(vectors, F.col("id") == F.col("_v")).drop("_v"))[0]


@query("""with n as (select p_partkey as k, p_name from part), t as (select s_suppkey as truth_id, p_name as nm from supplier join n on k = s_suppkey), f as (select c_custkey as case_id, p_name as nm from customer join n on k = c_custkey)
select (select count(*) from supplier join n on k = s_suppkey) as truth_count, (select count(*) from f) as pipeline_count, (select coalesce(sum(least(nt, nf)), 0) from (select nm, count(*) as nt from t group by 1) join (select nm, count(*) as nf from f group by 1) using (nm))::bigint as true_positive""")
def verify_run(spark, sf_dir):
    """Suppliers as truth and customers as cases, both named after parts; names are spelled out so that only equal ones agree."""
    spelled = F.concat(F.substring(F.sha2("p_name", 256), 1, 1), F.translate(F.substring(F.sha2("p_name", 256), 1, 40), "0123456789", "ghijklmnop"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.array(spelled).alias("names"))
    none = lambda c: F.lit(None).cast(c)
    side = lambda t, k, name: table(spark, sf_dir, t).join(part, F.col(k) == F.col("p_partkey")).select(F.col(k).alias(name), "names", none("string").alias("city"), none("string").alias("place"), none("date").alias("date"))
    scores = stages.verify_run(side("supplier", "s_suppkey", "truth_id"), side("customer", "c_custkey", "case_id"))[0]
    return scores.select("truth_count", "pipeline_count", "true_positive")


@query("""with t as (select doc_id as title_id, doc_id % 12 as m, case doc_id % 3 when 0 then 'known' when 1 then 'follow' else 'plain' end as kind from documents) select title_id, case when kind = 'known' and m < 6 then 'known_case' when title_id % 7 = 0 then 'extract' when kind = 'follow' then 'followup' else 'not_relevant' end as stage from t""")
def title_funnel(spark, sf_dir):
    k = F.col("doc_id")
    title = F.when(k % 3 == 0, "مقتل بكر ياسين في عرابة").when(k % 3 == 1, "تمديد اعتقال").otherwise("خبر")
    titles = table(spark, sf_dir, "documents").select(k.alias("title_id"), title.alias("title"), F.format_string("2025-%02d", k % 12).alias("month"))
    known = spark.createDataFrame([("بكر محمود ياسين", f"2025-{m:02d}") for m in range(6)], "case_name string, month string")
    verdicts = titles.where("title_id % 7 = 0").select("title_id", F.lit(True).alias("relevant"))
    return stages.title_funnel(titles, known, verdicts).select("title_id", "stage")


@query(f"""with {_C}, s as (select case_id, unnest(range(1, {_N} + 1)) as i, death_date, day from c) select case_id, i::int as source, array_to_string(list_sort(list_filter([case when date_diff('day', death_date, day + (i * 7)::int) <= 2 then 'initial_report' when date_diff('day', death_date, day + (i * 7)::int) >= 14 then 'follow_up' when death_date is not null then 'update_report' end, case when i = 2 then 'arabic_local_coverage' end, case when i = 3 then 'official_confirmation' end], lambda x: x is not null)), ',') as roles from s""")
def source_roles(spark, sf_dir):
    long = file(spark, sf_dir).select("case_id", "death_date", F.posexplode("sources").alias("i", "s"))
    return long.select("case_id", (F.col("i") + 1).alias("source"), F.array_join(stages.source_roles(F.col("s.published"), F.col("death_date"), F.col("s.language"), F.col("s.tier")), ",").alias("roles"))
