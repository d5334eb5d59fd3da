"""Connectors of news sites as readers with an injected fetch: a registry, the robots gate, paged and windowed walks,
fallbacks, redirects, article pages, retries and batches of model calls.

Sites differ in parameters only. What reaches the network is a function of the
caller's (module:function), so everything here runs the same on recorded answers.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from urllib.robotparser import RobotFileParser

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casegraph.functions import html as H
from casegraph.functions.text import content_type, first_path_segment, host
from casegraph.functions.urls import allowed_host
from casegraph.sources.feeds import FULL, FeedSource, first_seen


@dataclass(frozen=True)
class Site:
    """How a site is read: the way (feed, pages or categories), its language, what is left out, and which readers follow if that gives nothing."""

    name: str
    way: str
    language: str
    hosts: tuple[str, ...]
    blocked: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    body: str = "article"
    fallback: str | None = None
    options: dict = field(default_factory=dict)


REGISTRY = {
    s.name: s
    for s in (
        Site("ynet", "feed", "he", ("https://www.ynet.co.il/",), fallback="feed"),
        Site("arab48", "pages", "ar", ("https://www.arab48.com/",), blocked=("sport", "culture", "opinion")),
        Site("israelhayom", "pages", "he", ("https://www.israelhayom.co.il/",), fallback="feed"),
        Site("kul_alarab", "pages", "ar", ("https://www.kul-alarab.com/",)),
        Site("makan", "feed", "ar", ("https://www.makan.org.il/",)),
        Site("panet", "feed", "ar", ("https://www.panet.com/",)),
        Site("walla", "feed", "he", ("https://news.walla.co.il/",)),
    )
}


def site(name: str) -> Site:
    if name not in REGISTRY:
        raise ValueError(f"unknown source: {name}; known are {', '.join(REGISTRY)}")
    return REGISTRY[name]


def windowed(spark: SparkSession, name: str, fetch: str, date_from: str, date_to: str, query: str = "", full: int = FULL) -> DataFrame:
    """A site's feed over windows of 48 hours, full ones halved."""
    s = site(name)
    spark.dataSource.register(FeedSource)
    reader = spark.read.format("feed").option("fetch", fetch).option("source", name).option("query", query).option("full", str(full))
    return reader.option("date_from", date_from).option("date_to", date_to).option("blocked", ",".join(s.blocked)).option("keywords", ",".join(s.keywords)).load()


def page_walk(fetch: Callable[[int], Iterable[tuple]], start, end, most: int = 200, pages: int = 50, old_pages: int = 1, blocked: tuple[str, ...] = (), wanted: tuple[str, ...] = ()) -> tuple[list[tuple], dict[str, int]]:
    """(url, title, published) rows of a newest-first listing and the counts of rows inside, after and before the window.

    The walk ends with an empty page, with so many rows, or after so many whole pages older than the window.
    Rows without a date are kept; blocked sections and titles without a wanted word aren't.
    """
    out, seen, counts, old = [], set(), {"in_window": 0, "post": 0, "pre": 0}, 0
    for number in range(1, pages + 1):
        rows = list(fetch(number))
        if not rows:
            break
        before = 0
        for url, title, published in rows:
            section = url.split("://", 1)[-1].split("/")[1] if url.count("/") > 2 else ""
            if url in seen or section in blocked or (wanted and not any(w in (title or "") for w in wanted)):
                continue
            seen.add(url)
            if published is not None and published >= end:
                counts["post"] += 1
            elif published is not None and published < start:
                counts["pre"] += 1
                before += 1
            else:
                counts["in_window"] += 1
                out.append((url, title, published))
                if len(out) >= most:
                    return out, counts
        old = old + 1 if before == len(rows) else 0
        if old >= old_pages:
            break
    return out, counts


def cursor_walk(fetch: Callable[[str | None], tuple[Iterable[tuple], str | None]], most: int = 200) -> list[tuple]:
    """Rows of an answer that names the next one by a cursor, until there's none or enough rows."""
    out, cursor = [], None
    while len(out) < most:
        rows, cursor = fetch(cursor)
        out += list(rows)
        if not cursor:
            break
    return out[:most]


def or_else(first: DataFrame, second: Callable[[], DataFrame]) -> DataFrame:
    """first, or second() if it has no rows."""
    return second() if first.isEmpty() else first


def discover(feeds: list[DataFrame], again: Callable[[], list[DataFrame]] | None = None, few: int = 3) -> DataFrame:
    """URLs of several feeds, each from the first that has it; if there are fewer than few, those of again() after them."""
    found = first_seen(feeds)
    if again is not None and found.limit(few).count() < few:
        found = first_seen([found, *again()])
    return found


def parse_rss(raw: DataFrame, column: str = "xml") -> DataFrame:
    """(url, title, published) of the items of RSS documents; a date that can't be read is null."""
    kind = "channel struct<item:array<struct<link:string,title:string,pubDate:string>>>"
    items = raw.select(F.explode(F.from_xml(F.col(column), kind, {"rowTag": "rss"})["channel"]["item"]).alias("i"))
    stamp = F.try_to_timestamp(F.regexp_replace("i.pubDate", r"^[A-Za-z]+,\s*", ""), F.lit("d MMM yyyy HH:mm:ss z"))
    return items.select(F.trim("i.link").alias("url"), F.trim("i.title").alias("title"), stamp.alias("published"))


def can_fetch(urls: DataFrame, robots: DataFrame) -> DataFrame:
    """urls (url) that their host's robots file (host, body) lets be read; a host without one lets all.

    A host's rules are parsed once in a batch.
    """
    columns = list(urls.columns)
    met = urls.withColumn("_host", host(F.col("url"))).join(robots.select(F.col("host").alias("_host"), F.col("body").alias("_body")), "_host", "left")

    def gate(batches):
        parsers: dict[str, RobotFileParser | None] = {}
        for df in batches:
            keep = []
            for h, body, url in zip(df["_host"], df["_body"], df["url"]):
                if h not in parsers:
                    parsers[h] = None
                    if isinstance(body, str):
                        parsers[h] = RobotFileParser()
                        parsers[h].parse(body.splitlines())
                keep.append(parsers[h] is None or parsers[h].can_fetch("*", url))
            yield df[keep][columns]

    return met.mapInPandas(gate, urls.schema)


def resolve(found: DataFrame, redirects: DataFrame, prefixes: list[str]) -> DataFrame:
    """found (url) with the target of each redirect (url, target) and only targets that begin with a prefix."""
    met = found.join(redirects.select(F.col("url").alias("_u"), F.col("target").alias("_t")).dropDuplicates(["_u"]), F.col("url") == F.col("_u"), "left")
    return met.withColumn("url", F.coalesce("_t", "url")).drop("_u", "_t").where(allowed_host(F.col("url"), prefixes))


def article(pages: DataFrame, name: str | None = None) -> DataFrame:
    """(url, title, body, published, content_type, fetch_status) of fetched pages (url, html).

    Title, date and body come from JSON-LD, then from meta tags, then from the article's element.
    """
    page = F.col("html")
    data = H.json_ld(page)
    tag = site(name).body if name else "article"
    body = F.coalesce(F.nullif(data["articleBody"], F.lit("")), F.nullif(H.clean_text(H.element(page, tag)), F.lit("")), H.clean_text(page))
    title = F.coalesce(F.nullif(data["headline"], F.lit("")), F.nullif(H.meta(page, "og:title"), F.lit("")), H.title(page))
    published = F.try_to_timestamp(F.coalesce(F.nullif(data["datePublished"], F.lit("")), F.nullif(H.meta(page, "article:published_time"), F.lit(""))))
    status = F.when(F.coalesce(page, F.lit("")) == "", "fetch_failed").otherwise("success")
    return pages.select("url", title.alias("title"), body.alias("body"), published.alias("published"), content_type(body).alias("content_type"), status.alias("fetch_status"))


def fetch_all(urls: DataFrame, fetch: Callable[[str], str], tries: int = 3, wait: float = 2.0) -> DataFrame:
    """(url, html, fetch_status, error): each URL fetched in a task, with retries; a failure is a row, not the end."""

    def run(batches):
        import pandas as pd

        for df in batches:
            rows = []
            for url in df["url"]:
                try:
                    rows.append((url, retry(lambda u=url: fetch(u), tries, wait), "success", None))
                except TimeoutError as e:
                    rows.append((url, None, "timeout", str(e)))
                except PermissionError as e:
                    rows.append((url, None, "blocked", str(e)))
                except Exception as e:  # noqa: BLE001
                    rows.append((url, None, "fetch_failed", str(e)))
            yield pd.DataFrame(rows, columns=["url", "html", "fetch_status", "error"])

    return urls.select("url").mapInPandas(run, "url string, html string, fetch_status string, error string")


def retry(call: Callable, tries: int = 3, wait: float = 2.0, longest: float = 8.0, on: tuple = (ConnectionError, TimeoutError), sleep: Callable = time.sleep):
    """call(), again after a failure of these kinds, each wait twice the one before; the last failure is raised."""
    for k in range(tries):
        try:
            return call()
        except on:
            if k == tries - 1:
                raise
            sleep(min(wait * 2**k, longest))


def batched(rows: DataFrame, call: Callable[[list[str]], list[str]], column: str, size: int = 30, out: str = "answer") -> DataFrame:
    """rows with a model's answer to each text, asked size at once; a batch that fails has null answers."""

    def run(batches):
        for df in batches:
            answers: list = []
            texts = df[column].tolist()
            for i in range(0, len(texts), size):
                part = texts[i : i + size]
                try:
                    got = list(call(part))
                except Exception:  # noqa: BLE001
                    got = []
                answers += [*got, *[None] * len(part)][: len(part)]
            yield df.assign(**{out: answers})

    return rows.mapInPandas(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [f"`{out}` string"]))


def sweep_plan(spark: SparkSession, sources: list[str], terms: list[str], windows: list[tuple[str, str]]) -> DataFrame:
    """One row per source, term and window of a sweep; sources are known ones."""
    rows = [(site(s).name, t, a, b) for s in sources for t in terms for a, b in windows]
    return spark.createDataFrame(rows, "source string, term string, date_from string, date_to string")


def window_of(date_to: Column, days: Column, date_from: Column | None = None) -> Column:
    """Struct of the first and last day: the given first one, else so many days before the last."""
    start = F.date_sub(date_to, days)
    return F.struct((F.coalesce(date_from, start) if date_from is not None else start).alias("date_from"), date_to.alias("date_to"))


def polygons(answers: DataFrame, order: list[str]) -> DataFrame:
    """(place, ring): of a place's answers (place, tag, ring) the one of the first tag that has a ring."""
    from casegraph.operators.tables import latest

    rank = F.array_position(F.array(*[F.lit(t) for t in order]), F.col("tag"))
    return latest(answers.where((F.size("ring") > 2) & (rank > 0)), ["place"], rank).select("place", "ring")


def section_allowed(url: Column, blocked: list[str]) -> Column:
    return ~first_path_segment(url).isin(*blocked) if blocked else F.lit(True)
