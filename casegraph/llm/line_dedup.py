"""Line dedup: explode normalised lines, hash, count distinct documents per hash,
drop the lines over the threshold and put the rest together by position.

A line's key is the line without ASCII blanks at its ends, with A-Z in lower
case. Only 128-bit hashes of keys, document ids and positions are shuffled by
key, from a table of them that is written once; the text itself moves once, by
document id, to meet the positions that it loses. The document count of a key is a partial aggregation, and the join that
gives a frequent key's lines their verdict is one that Spark splits when skewed.

Null and empty texts are one empty line. Rows without an id keep all their lines.
Of rows that repeat an id, each is treated alike: an id counts as one document,
and a line to drop goes from all its rows. Ties can't arise, since the smallest id
that holds a line keeps it. Very long texts are split whole. Other columns take no
part, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casegraph.operators.graph import durable, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "\t\n\x0b\x0c\r "


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all else untouched."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, _lines, _dropped, and the columns to keep): each row's lines and the sorted positions that it loses.

    Lines whose key has min_chars code points or more and stands in min_docs
    documents or more stay only in the smallest id that holds the key.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("_lines"), *keep)
    lines = source.where("_id is not null").select("_id", F.posexplode("_lines").alias("_pos", "_line"))
    keyed = lines.select("_id", "_pos", line_key(F.col("_line")).alias("_key")).where(F.length("_key") >= min_chars)
    # stored, so that texts are split and hashed once for the counts and the join
    hashed = stored(keyed.select("_id", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("line"), "_key", F.lit(7)).alias("_h2")))
    if min_docs == 2:
        # two documents at least: the smallest and the largest id differ; no distinct is needed
        counts = hashed.groupBy("_h1", "_h2").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).where("_first <> _last").drop("_last")
    else:
        once = hashed.select("_h1", "_h2", "_id").distinct()
        counts = once.groupBy("_h1", "_h2").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where(F.col("_n") >= min_docs).drop("_n")
    drop = hashed.join(durable(counts), ["_h1", "_h2"]).where("_id <> _first").select("_id", "_pos")
    per_doc = drop.groupBy("_id").agg(F.array_sort(F.collect_set("_pos")).alias("_dropped"))
    return source.join(per_doc, "_id", "left").withColumn("_dropped", F.coalesce("_dropped", F.array().cast("array<int>")))


def kept_text(deduped: DataFrame) -> DataFrame:
    """Adds _kept, the lines that stay joined by newlines, to the result of dedup_lines()."""
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    joined = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    return deduped.withColumn("_kept", F.when(F.size("_dropped") == 0, F.array_join("_lines", "\n")).otherwise(joined))


#: DuckDB SQL for the query op2.
SQL = r"""
with lines as (
  select doc_id, generate_subscripts(ls, 1) as pos, unnest(ls) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)),
keyed as (
  select doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
dup as (
  select k, min(doc_id) as first_id from keyed where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
marked as (
  select keyed.doc_id, pos, line, coalesce(keyed.doc_id <> first_id, false) as gone from keyed left join dup using (k))
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
