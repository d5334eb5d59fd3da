"""A case's images from candidates of its articles: precision rules, duplicates, representatives, evidence, one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casegraph.functions import captions as C, values as V
from casegraph.functions.text import host
from casegraph.functions.vectors import cosine
from casegraph.operators import media
from casegraph.operators.tables import latest, top_k


def first_per_article(df: DataFrame, most: int = V.PER_ARTICLE) -> DataFrame:
    """Candidates (article_url, source_url, pos) off the blocklist, each URL once, so many an article."""
    allowed = df.where(C.url_allowed(F.col("source_url")))
    return top_k(latest(allowed, ["article_url", "source_url"], F.col("pos")), ["article_url"], most, F.col("pos"), F.col("source_url"))


def once_per_article(df: DataFrame) -> DataFrame:
    """Equal bytes of one article once, a captioned candidate first; candidates without a digest all stay."""
    captioned = F.coalesce(F.nullif(F.coalesce("figcaption", "caption"), F.lit("")), F.lit("")) != ""
    w = Window.partitionBy("case_id", "article_url", "sha256").orderBy(captioned.desc(), "pos", "media_key")
    return df.withColumn("_rn", F.when(F.col("sha256").isNull(), 1).otherwise(F.row_number().over(w))).where("_rn = 1").drop("_rn")


def same_image(df: DataFrame, case: str = "case_id", id_col: str = "media_key", least: float = V.IMAGE_COSINE) -> DataFrame:
    """(id_a, id_b) of one case with equal digests, close perceptual hashes, or vectors of a cosine of least or more.

    Vectors are met in one case only, whose candidates are capped.
    """
    links = media.same_image(df, case, id_col, "sha256", "phash")
    if "vector" not in df.columns:
        return links
    v = df.where(F.col("vector").isNotNull()).select(F.col(case).alias("_case"), F.col(id_col).alias("_id"), F.col("vector").alias("_v"))
    a, b = v.alias("a"), v.alias("b")
    near = a.join(b, (F.col("a._case") == F.col("b._case")) & (F.col("a._id") < F.col("b._id"))).where(cosine(F.col("a._v"), F.col("b._v")) >= least)
    return links.unionByName(near.select(F.col("a._id").alias("id_a"), F.col("b._id").alias("id_b"))).distinct()


def finalize(candidates: DataFrame, context: DataFrame) -> DataFrame:
    """One row per image of a case, with its type, evidence and reason, or nothing if the precision rules leave it out.

    candidates: case_id, media_key, article_url, source_url, figcaption, caption, alt_text, selector, category, confidence, is_stock,
    stock_confidence, width, height, sha256, phash, pos. context: case_id, victims, suspects and cities (arrays), one row per case.
    """
    met = candidates.join(context, "case_id").withColumn("text", C.caption_text(F.col("figcaption"), F.col("caption"), F.col("alt_text")))
    met = met.where(C.mismatch(F.col("text"), F.col("victims"), F.col("suspects"), F.col("cities")).isNull())
    capped = once_per_article(top_k(met, ["case_id"], V.PER_CASE, F.col("pos"), F.col("media_key")))
    grouped = media.clusters(capped, same_image(capped), "media_key").withColumnRenamed("component", "cluster")
    area = F.coalesce(F.col("width"), F.lit(0)) * F.coalesce(F.col("height"), F.lit(0))
    rep = media.representative(grouped, "cluster", area, F.coalesce("figcaption", "caption", F.lit("")), F.col("source_url"))
    whole = grouped.groupBy("cluster").agg(
        F.array_sort(F.collect_set("source_url")).alias("_urls"), F.array_sort(F.collect_set("article_url")).alias("source_article_urls"),
        F.count_distinct(host(F.col("article_url"))).alias("publishers"), F.bool_or(F.startswith("selector", F.lit("meta:og:image"))).alias("_og"), F.bool_or(F.startswith("selector", F.lit("meta:twitter:image"))).alias("_tw"),
    )
    # a lead image stays one, whichever copy stands for it
    selector = F.when(F.col("_og"), "meta:og:image").when(F.col("_tw"), "meta:twitter:image").otherwise(F.col("selector"))
    made = rep.join(whole, "cluster").withColumn("selector", selector)
    row = {"text": F.col("text"), "is_stock": F.col("is_stock"), "stock_confidence": F.col("stock_confidence"), "category": F.col("category"), "confidence": F.col("confidence"), "selector": F.col("selector")}
    told = made.withColumn("_e", media.evidence_decision(row, F.col("victims"), F.col("suspects"), F.col("cities"), []))
    alone = (F.col("_e.reason") == "og_image_lead") & (F.col("publishers") < 2)
    told = told.withColumns({"is_evidence": F.col("_e.is_evidence") & ~alone, "evidence_reason": F.when(alone, "og_image_lead:single_publisher_unverified").otherwise(F.col("_e.reason"))})
    keep = {"text": F.col("text"), "category": F.col("category"), "is_evidence": F.col("is_evidence"), "selector": F.col("selector"), "article_urls": F.col("source_article_urls")}
    kept = told.where(C.keep_media(keep, F.col("victims"), F.col("suspects"), F.col("cities")))
    shy = C.lead_without_caption(F.col("category"), F.col("confidence"), F.col("text"), F.col("is_evidence"), F.col("selector"))
    return kept.withColumn("_shy", shy).select(
        "case_id", media.media_id(F.col("phash"), F.col("sha256"), F.col("source_url")).alias("media_id"), F.col("_shy.category").alias("type"), F.col("source_url").alias("primary_url"),
        F.array_remove("_urls", F.col("source_url")).alias("mirror_urls"), "source_article_urls", F.size("source_article_urls").alias("appearance_count"), F.coalesce("figcaption", "caption").alias("caption"),
        F.col("_shy.confidence").alias("confidence"), "is_evidence", "evidence_reason",
    )


def attach(cases: DataFrame, images: DataFrame) -> DataFrame:
    """cases with their images as media and media_evidence."""
    whole = F.struct(*[c for c in images.columns if c != "case_id"])
    kind = lambda yes: F.array_sort(F.collect_list(F.when(F.col("is_evidence") == F.lit(yes), whole)))
    by_case = images.groupBy(F.col("case_id").alias("_case")).agg(kind(False).alias("media"), kind(True).alias("media_evidence"))
    return cases.drop("media", "media_evidence").join(by_case, F.col("case_id") == F.col("_case"), "left").drop("_case")


def attribution(images: DataFrame, sources: DataFrame) -> DataFrame:
    """images (case_id, media_id, source_article_urls) with the publisher of the first article, if it is a source (case_id, url, publisher) of the case."""
    keyed = images.withColumn("_url", F.get("source_article_urls", F.lit(0)))
    names = sources.select(F.col("case_id").alias("_case"), F.col("url").alias("_u"), F.col("publisher").alias("attribution")).dropDuplicates(["_case", "_u"])
    return keyed.join(names, (F.col("case_id") == F.col("_case")) & (F.col("_url") == F.col("_u")), "left").drop("_case", "_u", "_url")


def harvested(articles: DataFrame, cache: DataFrame, version: int, harvest) -> DataFrame:
    """Candidates of all articles: those of the cache at this version or later, and harvest(articles) of the rest."""
    fresh = cache.where(F.col("version") >= version)
    left = articles.join(fresh.select("article_url").distinct(), "article_url", "left_anti")
    return fresh.drop("version").unionByName(harvest(left), allowMissingColumns=True)


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)
