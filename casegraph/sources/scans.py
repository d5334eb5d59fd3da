"""Scans of the stores: articles, extractions, cases, edges, dictionaries and runs, with the filters and orders of each."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casegraph.operators.tables import latest
from casegraph.sources.stores import place_key


def open_store(spark: SparkSession, path: str, tables: dict[str, str]) -> dict[str, DataFrame]:
    """A store's tables by name, with all columns that any of their files has; a table without files is empty with the given schema.

    A schema's columns that no file has yet are added as nulls, so an older store reads like a new one.
    """
    out = {}
    jvm = spark._jvm.org.apache.hadoop.fs
    for name, schema in tables.items():
        where = jvm.Path(f"{path}/{name}")
        empty = spark.createDataFrame([], schema)
        if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            out[name] = empty
            continue
        found = spark.read.option("mergeSchema", True).parquet(f"{path}/{name}")
        out[name] = found.withColumns({f.name: F.lit(None).cast(f.dataType) for f in empty.schema if f.name not in found.columns})
    return out


def run_is(column: Column, run: str) -> Column:
    """all takes every run, a name with * at its end all that begin with it, another name itself."""
    if run == "all":
        return F.lit(True)
    return F.startswith(column, F.lit(run[:-1])) if run.endswith("*") else column == run


def articles_by_status(articles: DataFrame, status: str, run: str = "all") -> DataFrame:
    """Articles of a fetch status, the oldest fetch first."""
    return articles.where((F.col("fetch_status") == status) & run_is(F.col("pipeline_run_id"), run)).orderBy("fetched_at", "id")


def extractions(records: DataFrame, articles: DataFrame | None = None, run: str = "all") -> DataFrame:
    """All extractions in order; with a run only those of its articles."""
    if run != "all" and articles is not None:
        records = records.join(articles.where(run_is(F.col("pipeline_run_id"), run)).select(F.col("id").alias("article_id")), "article_id", "left_semi")
    return records.orderBy("extracted_at", "id")


def extractions_of(records: DataFrame, article_id) -> DataFrame:
    """An article's extractions, the newest first."""
    return records.where(F.col("article_id") == article_id).orderBy(F.desc("extracted_at"), F.desc("id"))


def with_articles(records: DataFrame, articles: DataFrame) -> DataFrame:
    """Extractions with their article's columns; one without an article goes."""
    own = articles.select(*[F.col(c).alias(f"article_{c}") if c != "id" else F.col("id").alias("article_id") for c in articles.columns])
    return records.join(own, "article_id")


def cases_of_run(cases: DataFrame, run: str) -> DataFrame:
    return cases.where(run_is(F.col("pipeline_run_id"), run)).orderBy("created_at", "id")


def universe(articles: DataFrame, records: DataFrame) -> DataFrame:
    """Fetched articles that triage let pass, each with its latest good extraction."""
    kept = articles.where((F.col("fetch_status") == "success") & F.col("triage_status").isin("yes", "maybe"))
    good = latest(records.where("extraction_status = 'success'"), ["article_id"], F.desc("extracted_at"), F.desc("id"))
    return with_articles(good, kept)


def to_reextract(articles: DataFrame, least: int = 200) -> DataFrame:
    """Fetched articles that triage let pass and whose text is longer than least, the newest first."""
    return articles.where((F.col("fetch_status") == "success") & F.col("triage_status").isin("yes", "maybe") & (F.length("article_text") > least)).orderBy(F.desc("fetched_at"), "id")


def cities(places: DataFrame) -> DataFrame:
    """(city): each place once, by its English name, else its Arabic one, in the file's order (pos)."""
    named = places.withColumn("city", F.coalesce(F.nullif("name_en", F.lit("")), F.nullif("name_ar", F.lit("")))).where("city is not null")
    return latest(named, ["city"], F.col("pos")).orderBy("pos").select("city")


def name_dictionary(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """The dictionary of name parts, a small file {Arabic: {he, en}}; without the file an empty one."""
    jvm = spark._jvm.org.apache.hadoop.fs
    where = jvm.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return {}
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,string>>").alias("d")).first()
    return dict(text.d or {})


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified) of the exports in a folder, the newest first; files that begin with _ are none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select("path", F.col("modificationTime").alias("modified"))
    return found.where(~F.startswith(F.element_at(F.split("path", "/"), -1), F.lit("_"))).orderBy(F.desc("modified"), F.desc("path"))


def newest_run(spark: SparkSession, folder: str) -> str | None:
    row = runs(spark, folder).first()
    return row.path if row else None


def review_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The pairs that an export leaves to a person."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("review_pairs").alias("p")).select("p.*")


def texts_for(keys: DataFrame, articles: DataFrame, key: str = "url") -> DataFrame:
    """keys with the text of their article, null if there's none."""
    return keys.join(articles.select(key, "article_text").dropDuplicates([key]), key, "left")


def merge_edges(edges: DataFrame) -> DataFrame:
    return edges.where("decision = 'merge'")


def review_edges(edges: DataFrame) -> DataFrame:
    """Edges for review, the most alike first."""
    return edges.where("decision = 'review'").orderBy(F.desc("cosine_score"), "record_a_id", "record_b_id")


def edge_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("decision").agg(F.count("*").alias("n"))


def case_at(snapshot: DataFrame, index: int) -> DataFrame:
    """The case of this place in a numbered snapshot; an empty table is the answer 404."""
    return snapshot.where(F.col("case_index") == index)


def places_by_alias(places: DataFrame) -> DataFrame:
    """(alias, name_en, district, region) of places with their aliases; the last place of an alias wins."""
    lists = [c for c in ("aliases_en", "aliases_ar", "aliases_he") if c in places.columns]
    names = F.array(*[c for c in ("name_en", "name_ar", "name_he") if c in places.columns])
    every = F.concat(names, *[F.coalesce(c, F.array().cast("array<string>")) for c in lists])
    posted = places.select("pos", "name_en", "district", "region", F.explode(every).alias("alias")).where("alias is not null").withColumn("alias", place_key(F.col("alias")))
    return latest(posted, ["alias"], F.desc("pos")).drop("pos")


@dataclass(frozen=True)
class Settings:
    """Settings of a run, from environment variables of the same names in capitals."""

    jaro_threshold: float = 0.88
    cosine_threshold: float = 0.72
    request_delay_seconds: float = 3.0
    max_article_tokens: int = 8000
    llm_max_tokens: int = 1024
    llm_concurrency: int = 8
    robots_txt_respect: bool = True
    output_dir: str = "output"
    log_level: str = "INFO"

    def __post_init__(self) -> None:
        for name in ("jaro_threshold", "cosine_threshold"):
            if not 0.0 <= getattr(self, name) <= 1.0:
                raise ValueError(f"{name} must lie between 0 and 1")
        if self.request_delay_seconds < 0:
            raise ValueError("request_delay_seconds must not be negative")
        for name in ("max_article_tokens", "llm_max_tokens", "llm_concurrency"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")


def settings(env: dict[str, str] | None = None) -> Settings:
    """Settings of the environment; a value out of its range or of another type is an error that names it."""
    env = dict(os.environ) if env is None else env
    given = {}
    for f in fields(Settings):
        raw = env.get(f.name.upper())
        if raw is None:
            continue
        try:
            given[f.name] = raw.strip().lower() in ("1", "true", "yes") if isinstance(f.default, bool) else type(f.default)(raw)
        except ValueError as e:
            raise ValueError(f"{f.name}: {raw!r} is not a {type(f.default).__name__}") from e
    return Settings(**given)
