"""Column functions on image captions: whom and where they name, what they show, and how sure that is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casegraph.functions import values as V


def folded(c: Column) -> Column:
    """Lower case, without Arabic marks, with letters of one sound folded."""
    return F.translate(F.regexp_replace(F.lower(c), V.CAPTION_MARKS, ""), V.FOLD_FROM, V.FOLD_TO)


def caption_text(*parts: Column) -> Column:
    """The parts that aren't empty, joined by spaces."""
    return F.trim(F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), " "))


def caption_tokens(names: Column) -> Column:
    """Distinct folded tokens of three letters or more of an array of names."""
    found = F.flatten(F.transform(names, lambda n: F.regexp_extract_all(folded(n), F.lit(r"([A-Za-z0-9\u0590-\u05FF\u0600-\u06FF]+)"), F.lit(1))))
    return F.array_distinct(F.filter(found, lambda t: F.length(t) >= 3))


def names_one(text: Column, names: Column) -> Column:
    """The folded text holds two tokens of one of the names, or the only one that it has."""

    def hit(n):
        t = caption_tokens(F.array(n))
        return (F.size(t) > 0) & (F.size(F.filter(t, lambda x: F.contains(text, x))) >= F.least(F.size(t), F.lit(2)))

    return F.exists(names, hit)


def has_marker(text: Column, markers) -> Column:
    return F.exists(F.array(*[folded(F.lit(m)) for m in markers]), lambda m: F.contains(text, m))


def mismatch(text: Column, victims: Column, suspects: Column, cities: Column) -> Column:
    """Why a caption belongs to another case: caption_names_other_victim, caption_mentions_other_location or null."""
    t = folded(text)
    towns = caption_tokens(cities)
    other_person = has_marker(t, V.PERSON_MARKERS) & (F.size(victims) > 0) & ~names_one(t, F.concat(victims, suspects))
    other_place = has_marker(t, V.LOCATION_MARKERS) & (F.size(towns) > 0) & ~F.exists(towns, lambda x: F.contains(t, x))
    return F.when(F.coalesce(text, F.lit("")) == "", None).when(other_person, "caption_names_other_victim").when(other_place, "caption_mentions_other_location")


def credit_only(name: Column, text: Column) -> Column:
    """The lower-case text holds the name, each time within 50 letters after a credit."""
    n = F.lower(name)
    parts = F.split(text, F.concat(F.lit(r"\Q"), n, F.lit(r"\E")), -1)
    before = F.slice(parts, F.lit(1), F.size(parts) - 1)
    # what stands before an occurrence is the text up to it, names in between included
    join = lambda some: F.aggregate(some, F.lit(None).cast("string"), lambda a, p: F.when(a.isNull(), p).otherwise(F.concat(a, n, p)))
    upto = F.transform(before, lambda p, i: F.right(join(F.slice(before, F.lit(1), i + 1)), F.lit(50)))
    return F.contains(text, n) & F.forall(upto, lambda w: w.rlike(V.CREDIT))


def relative_of_victim(text: Column) -> Column:
    """A relation word right before a victim word: the picture shows the relative."""
    return text.rlike("(?:" + "|".join(V.RELATIONS) + ") (?:" + "|".join(V.VICTIM_WORDS) + ")")


def stock_signal(url: Column, text: Column) -> Column:
    """Struct of is_stock, confidence and evidence: a stock agency's host, else a caption that says so."""
    hit = lambda c, words: F.get(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, F.lower(w))), F.lit(0))
    host, word = hit(F.lower(F.coalesce(url, F.lit(""))), V.STOCK_DOMAINS), hit(F.coalesce(text, F.lit("")), V.STOCK_MARKERS)
    make = lambda yes, conf, why: F.struct(F.lit(yes).alias("is_stock"), F.lit(conf).cast("double").alias("confidence"), why.alias("evidence"))
    return (
        F.when(host.isNotNull(), make(True, 0.95, F.concat(F.lit("stock:domain:"), host)))
        .when(word.isNotNull(), make(True, 0.85, F.concat(F.lit("stock:caption:"), F.left(word, F.lit(16)))))
        .otherwise(make(False, 0.0, F.lit(None).cast("string")))
    )


def keyword_class(text: Column, victims: Column, suspects: Column, categories: dict[str, list[str]] = V.CATEGORY_WORDS) -> Column:
    """Struct of category, confidence and evidence by the words of a lower-case caption.

    No text 0.2; a relative of a victim 0.3; a victim's name 0.92 or a suspect's 0.88, if it isn't a credit; else the
    category with most words (the first of several), 0.5 and 0.15 a word up to 0.92, or other at 0.3.
    """
    make = lambda k, c, e: F.struct(k.alias("category"), c.cast("double").alias("confidence"), e.alias("evidence"))
    named = lambda names: F.get(F.filter(names, lambda n: (n != "") & F.contains(text, F.lower(n)) & ~credit_only(n, text)), F.lit(0))
    victim, suspect = named(victims), named(suspects)
    hits = {k: F.filter(F.array(*[F.lit(w) for w in v]), lambda w: F.contains(text, F.lower(w))) for k, v in categories.items()}
    most = F.greatest(*[F.size(h) for h in hits.values()], F.lit(0))
    kind, words = F.lit("other"), F.array().cast("array<string>")
    for k in reversed(list(hits)):
        best = (F.size(hits[k]) == most) & (most > 0)
        kind, words = F.when(best, k).otherwise(kind), F.when(best, hits[k]).otherwise(words)
    told = F.array_join(F.transform(F.slice(words, 1, 3), lambda w: F.left(w, F.lit(16))), ",")
    scored = make(kind, F.when(most > 0, F.least(F.lit(0.92), 0.5 + 0.15 * most)).otherwise(0.3), F.when(most > 0, F.concat(F.lit("keyword:"), kind, F.lit(":"), told)).otherwise("keyword:no_match"))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", make(F.lit("other"), F.lit(0.2), F.lit("keyword:no_text_signal")))
        .when(relative_of_victim(text), make(F.lit("other"), F.lit(0.3), F.lit("keyword:family_relation_of_victim")))
        .when(victim.isNotNull(), make(F.lit("victim_portrait"), F.lit(0.92), F.concat(F.lit("caption_match:victim_name:"), F.left(victim, F.lit(24)))))
        .when(suspect.isNotNull(), make(F.lit("suspect_portrait"), F.lit(0.88), F.concat(F.lit("caption_match:suspect_name:"), F.left(suspect, F.lit(24)))))
        .otherwise(scored)
    )


def prompt_class(scores: Column, labels: Column) -> Column:
    """Struct of label and score: the first best of an array of prompt similarities."""
    best = F.array_max(scores)
    return F.struct(F.get(labels, (F.array_position(scores, best) - 1).cast("int")).alias("label"), best.alias("score"))


def cascade(keyword: Column, prompted: Column, place: Column) -> Column:
    """Struct of category, confidence and tier: the keyword class if it is sure enough, else the more confident of both;
    vision_skipped tells that neither is sure and the case's budget of VISION_CALLS still has room at this place."""
    surer = F.coalesce(prompted["score"] > keyword["confidence"], F.lit(False)) & (keyword["confidence"] < V.KEYWORD_ENOUGH)
    kind = F.when(surer, prompted["label"]).otherwise(keyword["category"])
    conf = F.when(surer, prompted["score"]).otherwise(keyword["confidence"])
    done = (keyword["confidence"] >= V.KEYWORD_ENOUGH) | (conf >= V.PROMPT_ENOUGH)
    return F.struct(kind.alias("category"), conf.alias("confidence"), F.when(surer, "clip").otherwise("keyword").alias("tier"), (~done & (place <= V.VISION_CALLS) & (conf < 0.5)).alias("vision_skipped"))


def prompts(victims: Column, suspects: Column, cities: Column) -> Column:
    """Map of a category and its prompt, with the first name or town that is known."""
    first = lambda names, lead: F.coalesce(F.concat(F.lit(lead), F.get(F.filter(names, lambda n: F.trim(n) != ""), F.lit(0))), F.lit(""))
    return F.create_map(
        F.lit("victim_portrait"), F.concat(F.lit("family snapshot of a victim"), first(victims, " featuring ")),
        F.lit("suspect_portrait"), F.concat(F.lit("police photo of a suspect"), first(suspects, " featuring ")),
        F.lit("crime_scene"), F.concat(F.lit("news photo of a crime scene"), first(cities, " in ")),
    )


def lead_without_caption(category: Column, confidence: Column, text: Column, evidence: Column, selector: Column) -> Column:
    """Struct of category and confidence: a case-named lead image without caption is not trusted to show what its class says."""
    shy = (text == "") & ~evidence & F.startswith(selector, F.lit("arab48:case_named_lead")) & ~F.coalesce(category, F.lit("other")).isin("other", "generic_stock")
    return F.struct(F.when(shy, "other").otherwise(category).alias("category"), F.when(shy, F.least(confidence, F.lit(0.35))).otherwise(confidence).alias("confidence"))


def keep_media(row: dict[str, Column], victims: Column, suspects: Column, cities: Column) -> Column:
    """The last precision rule. row gives text, category, is_evidence, selector and article_urls (of the image's whole cluster)."""
    text, t = row["text"], folded(row["text"])
    people = F.concat(victims, suspects)
    useful = F.coalesce(row["category"].isin(*V.MEANINGFUL), F.lit(False))
    head = F.startswith(row["selector"], F.lit("meta:og:image")) | F.startswith(row["selector"], F.lit("meta:twitter:image"))
    by_url = head & F.exists(row["article_urls"], lambda u: names_one(folded(F.try_url_decode(u)), people))
    lead = F.startswith(row["selector"], F.lit("arab48:case_named_lead")) | by_url
    signal = names_one(t, people) | F.exists(caption_tokens(cities), lambda x: F.contains(t, x))
    return (
        F.when(mismatch(text, victims, suspects, cities).isNotNull(), False)
        .when(row["is_evidence"], True)
        .when(F.coalesce(row["category"] == "generic_stock", F.lit(False)), False)
        .when(F.coalesce(text, F.lit("")) == "", lead | useful)
        .otherwise(signal | useful)
    )


def url_allowed(url: Column) -> Column:
    """No part of the URL is on the blocklist."""
    return ~F.exists(F.array(*[F.lit(b) for b in V.BLOCKED_URLS]), lambda b: F.contains(F.lower(url), b))


def host_image_allowed(url: Column, domain: str, allow: list[str], reject: list[str]) -> Column:
    """An image of a site's own hosts, with an allowed and without a rejected mark in its path."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]+)", 1))
    path = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1))
    marked = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(path, w))
    return F.endswith(host, F.lit(f".{domain}")) & marked(allow) & ~marked(reject)


def body_image(text: Column, page_names_case: Column, url: Column, people: Column, cities: Column, context: list[str], body_path: str = "/bodyimages/images/") -> Column:
    """A body image belongs to the case by its caption's name, by its town with a word of the context, or, without a caption, by a page that names the case."""
    t = folded(text)
    town = F.exists(caption_tokens(cities), lambda x: F.contains(t, x)) & has_marker(t, context)
    blank = F.coalesce(text, F.lit("")) == ""
    return F.when(blank, page_names_case & F.contains(F.lower(url), F.lit(body_path))).otherwise(names_one(t, people) | town)
