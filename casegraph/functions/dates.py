"""Column functions on dates that may be partial, misplaced or off by years."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole_date(c: Column) -> Column:
    """The date of an ISO string; null if any part is unknown (X or ?) or missing."""
    return F.when(c.rlike("[Xx?]"), None).otherwise(F.try_to_date(F.substring(F.trim(c), 1, 10), "yyyy-MM-dd"))


def with_year(d: Column, year: Column) -> Column:
    """d in another year; null if that day doesn't exist."""
    return F.try_to_date(F.format_string("%04d-%s", year, F.date_format(d, "MM-dd")), "yyyy-MM-dd")


def clamp_year(d: Column, published_year: Column) -> Column:
    """Dates after the published year, or one or two years before it, move to it; older ones, and 29 February without a counterpart, stay."""
    gap = published_year - F.year(d)
    return F.when((gap < 0) | gap.between(1, 2), F.coalesce(with_year(d, published_year), d)).otherwise(d)


def same_month(a: Column, b: Column) -> Column:
    """Months are equal, or one is unknown."""
    return F.coalesce(F.date_format(a, "yyyy-MM") == F.date_format(b, "yyyy-MM"), F.lit(True))


def days_apart(a: Column, b: Column) -> Column:
    return F.abs(F.date_diff(a, b))


def window_start(ts: Column, hours: int) -> Column:
    """Start of the window of so many hours since 1970 that holds ts."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / (hours * 3600)) * (hours * 3600))


def parse_any(c: Column, formats: list[str]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def date_from_path(url: Column) -> Column:
    return F.try_to_date(F.regexp_extract(url, r"/(\d{4}/\d{2}/\d{2})(?:/|$)", 1), "yyyy/MM/dd")


def adaptive_window(df, ts: str, most: int, hours: tuple[int, ...] = (48, 24, 12, 6, 3)):
    """Adds window_start and window_hours: the widest window of a row that holds at most so many rows, else the narrowest.

    Counts per level are partial aggregations; a level is looked at only for rows that the wider ones left.
    """
    done, left = None, df
    for h in hours:
        placed = left.withColumn("window_start", window_start(F.col(ts).cast("timestamp"), h))
        counts = placed.groupBy("window_start").agg(F.count("*").alias("_n")).where(F.col("_n") > most)
        fits = placed.join(counts, "window_start", "left_anti") if h != hours[-1] else placed
        part = fits.select(*df.columns, F.col("window_start"), F.lit(h).alias("window_hours"))
        done = part if done is None else done.unionByName(part)
        if h != hours[-1]:
            left = placed.join(counts.select("window_start"), "window_start", "left_semi").select(*df.columns)
    return done
