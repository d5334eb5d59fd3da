"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept:
quality classifier, line dedup, MinHash near-dedup, benchmark decontamination and
byte-level BPE. All but the last return the columns of documents; text and
n_chars follow what a stage keeps of a text. A stage's table goes as soon as the
next one is written.

Null and empty texts are scored by the intercept, are one empty line, near copies
of nothing and no test item, and have no tokens; null stays null until the last
stage. Rows without an id keep their lines and are near copies of nothing. Rows
that repeat an id are one document for line and near dedup and go or stay together
there. Ties go to the smallest id. Very long texts are read whole. Extra columns,
whatever their names, come along to the last stage but one. An empty table gives
an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from casegraph.llm import bpe, decontamination, line_dedup, near_dups, quality
from casegraph.operators.graph import discard, stored

#: Documents that score less are rejected.
QUALITY = 0.3
#: Documents are near copies from this similarity on; op5's 85 is its own contract.
NEAR_PERCENT = 80
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def same_columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is QUALITY or more; null and empty texts have the intercept's."""
    weights = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = quality.fresh(docs.columns)
    return quality.score(docs, weights, out=name).where(F.col(name) >= QUALITY).select(same_columns(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller doc_id holds; one that loses all its lines goes, one without an id loses none."""
    # the text goes along once, as lines
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*rest, F.col("text").isNull().alias("_none")).alias("_row"), F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))
    out = line_dedup.kept_text(line_dedup.dedup_lines(rows, "_doc", "_text", keep=("_row",)))
    out = out.where(~((F.size("_dropped") > 0) & (F.size("_dropped") == F.size("_lines"))))
    text = F.when(~F.col("_row._none"), F.col("_kept"))
    columns = {"text": text, "n_chars": F.when(F.size("_dropped") > 0, F.length("_kept").cast("long")).otherwise(F.col("_row.n_chars"))}
    return out.select(*[columns[c].alias(c) if c in columns else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id. Empty texts and rows without an id stay."""
    found = near_dups.near_duplicates(docs, percent=NEAR_PERCENT)
    gone = found.where("id <> component").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti").select(same_columns(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    found = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(same_columns(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids, with a digest of the text that these decode to."""
    out = bpe.round_trip(docs, public_tokenizers.path(VOCABULARY))
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("byte-level bpe", bpe_stage),
]

#: SQL can't express the classifier and the near-dedup; tests hold run() against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the stages' tables go to the session's shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir))
        discard(before)
    return docs
