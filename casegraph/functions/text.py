"""Column functions on names, scripts, content and identifiers."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from casegraph.functions.values import BACKGROUND, DIED, HONORIFICS, INJURED, NAME_AND_CITY, PLACEHOLDERS, PUBLISHERS, SEARCHES, SURVIVED

# Letters and their Latin forms; a letter without one is dropped.
ARABIC = {
    "ا": "", "أ": "a", "إ": "i", "آ": "a", "ب": "b", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r", "ز": "z",
    "س": "s", "ش": "sh", "ص": "s", "ض": "d", "ط": "t", "ظ": "z", "ع": "", "غ": "gh", "ف": "f", "ق": "q", "ك": "k", "ل": "l", "م": "m", "ن": "n",
    "ه": "h", "و": "w", "ي": "y", "ى": "y", "ة": "h", "ء": "", "ؤ": "w", "ئ": "y",
}
HEBREW = {
    "א": "", "ב": "b", "ג": "g", "ד": "d", "ה": "h", "ו": "w", "ז": "z", "ח": "h", "ט": "t", "י": "y", "כ": "k", "ך": "k", "ל": "l", "מ": "m", "ם": "m",
    "נ": "n", "ן": "n", "ס": "s", "ע": "", "פ": "f", "ף": "f", "צ": "s", "ץ": "s", "ק": "q", "ר": "r", "ש": "sh", "ת": "t",
}
#: A letter and its mark that stand for one sound; they are read before single letters.
DIGRAPHS = {"ג'": "j", "ז'": "z", "ד'": "d"}
ACCENTED, PLAIN = "àâäáãåçèéêëìíîïñòóôöõùúûüýÿß", "aaaaaaceeeeiiiinooooouuuuyys"
ARABIC_MARKS = "[\u064b-\u065f\u0610-\u061a\u06d6-\u06dc]"


def present(c: Column) -> Column:
    """Neither null nor blank nor a placeholder word."""
    return F.coalesce(~F.lower(F.trim(c)).isin(*PLACEHOLDERS), F.lit(False))


def first_present(*cols: Column) -> Column:
    """The first of the columns that isn't blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


@F.pandas_udf(StringType())
def compose(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition."""
    return s.str.normalize("NFKC")


def normalize_arabic(c: Column) -> Column:
    return F.trim(F.regexp_replace(compose(c), ARABIC_MARKS, ""))


def strip_words(c: Column, words: list[str]) -> Column:
    """c without the given words, in order."""
    for w in words:
        c = F.replace(c, F.lit(w), F.lit(""))
    return F.trim(c)


def romanize(c: Column) -> Column:
    """Lower-case Latin letters and single spaces, without marks and honorifics; accents fold, unknown letters drop."""
    out = F.lower(strip_words(F.regexp_replace(c, ARABIC_MARKS, ""), list(HONORIFICS)))
    for k, v in DIGRAPHS.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    single = {k: v for k, v in (ARABIC | HEBREW).items() if len(v) == 1}
    for k, v in (ARABIC | HEBREW).items():
        if len(v) != 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    out = F.translate(out, "".join(single) + ACCENTED, "".join(single.values()) + PLAIN)
    return F.trim(F.regexp_replace(F.regexp_replace(out, "[^a-z ]", ""), " +", " "))


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.trim(c), " +"), lambda t: t != "")


def surname(c: Column) -> Column:
    """All but the first token; null if there is but one."""
    return F.nullif(F.array_join(F.slice(tokens(c), 2, 1000), " "), F.lit(""))


def strict_subset(a: Column, b: Column) -> Column:
    """One token set lies strictly in the other, both of two tokens or more."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    inside = ((F.size(F.array_except(x, y)) == 0) & (F.size(x) < F.size(y))) | ((F.size(F.array_except(y, x)) == 0) & (F.size(y) < F.size(x)))
    return F.coalesce((F.size(tokens(a)) >= 2) & (F.size(tokens(b)) >= 2) & inside, F.lit(False))


def mentions(text: Column, name: Column, at_least: int = 2) -> Column:
    """The text holds at_least of the name's tokens, or the one that it has."""
    t = tokens(name)
    hits = F.size(F.filter(t, lambda x: F.contains(text, x)))
    return hits >= F.least(F.lit(at_least), F.greatest(F.size(t), F.lit(1)))


#: Letters of each script, as a class for regular expressions.
SCRIPTS = {"latin": "A-Za-z", "accented": "À-ÖØ-öø-ÿ", "arabic": "ء-ي", "hebrew": "א-ת"}


def script_count(c: Column, script: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{SCRIPTS[script]}]", "")).cast("long")


def script_purity(c: Column, script: str) -> Column:
    """Share of the script's letters among the letters of all scripts; null without letters."""
    total = sum((script_count(c, s) for s in SCRIPTS), F.lit(0))
    return F.try_divide(script_count(c, script).cast("double"), total)


def content_type(c: Column, least_words: int = 50, markers: tuple[str, ...] = ("subscribe", "premium")) -> Column:
    """non_article under least_words words, partial with a paywall marker, else article."""
    n = F.size(F.split(c, " "))
    marked = F.lit(False)
    for m in markers:
        marked = marked | F.contains(F.lower(c), F.lit(m))
    return F.when(F.coalesce(n, F.lit(0)) < least_words, "non_article").when(marked, "partial").otherwise("article")


def url_hash(c: Column, size: int = 16) -> Column:
    return F.substring(F.sha2(c, 256), 1, size)


def sources_hash(urls: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(urls), "|"), 256)


def host(url: Column) -> Column:
    """The host in lower case without www."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]+)", 1)), r"^www\.", "")


def first_path_segment(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]+/([^/?#]*)", 1)


def publisher(url: Column, known: dict[str, str] = PUBLISHERS) -> Column:
    """The display name of a known host, the first that the host holds; else the host's first label, capitalised; Unknown without a host."""
    h = host(url)
    out = F.when(h == "", "Unknown").otherwise(F.initcap(F.substring_index(h, ".", 1)))
    for domain, name in reversed(known.items()):
        out = F.when(F.contains(h, F.lit(domain)), name).otherwise(out)
    return out


def keyword_category(text: Column, categories: dict[str, list[str]]) -> Column:
    """Struct of the category with most keyword hits (the first of several) and its confidence, .5 + .15 a hit up to .92."""
    low = F.lower(text)
    hits = {k: sum((F.when(F.contains(low, F.lit(w)), 1).otherwise(0) for w in v), F.lit(0)) for k, v in categories.items()}
    most = F.greatest(*hits.values(), F.lit(0))
    name = F.lit(None).cast("string")
    for k in reversed(list(hits)):
        name = F.when((hits[k] == most) & (most > 0), k).otherwise(name)
    return F.struct(name.alias("category"), F.when(most > 0, F.least(F.lit(0.92), 0.5 + 0.15 * most)).otherwise(0.0).alias("confidence"))


def sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"(?<=[.!?؟])\s+|\n+"), lambda s: F.trim(s)), lambda s: s != "")


def holds_any(c: Column, words) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, w))


def lethality(current: Column, c: Column, survived=SURVIVED, injured=INJURED, died=DIED, background=BACKGROUND) -> Column:
    """The outcome after a look at the text: died stays; survived by its own words, or if a sentence tells of an injury
    and not of a death and no sentence tells of a death but as background; else what it was."""
    told = sentences(F.coalesce(c, F.lit("")))
    blocking = F.exists(told, lambda s: holds_any(s, died) & ~holds_any(s, background))
    hurt = F.exists(told, lambda s: holds_any(s, injured) & ~holds_any(s, died))
    alive = holds_any(F.coalesce(c, F.lit("")), survived) | (hurt & ~blocking)
    return F.when(F.coalesce(current == "died", F.lit(False)), current).when(alive, "survived").otherwise(current)


def prompt(parts: list[tuple[str, Column]], limits: dict[str, int]) -> Column:
    """Named blocks of data between fences, each cut to its limit (a model's input has one), joined by newlines."""
    block = lambda n, c: F.concat(F.lit(f"<{n}>\n"), F.left(F.coalesce(c, F.lit("")), F.lit(limits[n])) if n in limits else F.coalesce(c, F.lit("")), F.lit(f"\n</{n}>"))
    return F.concat_ws("\n", *[block(n, c) for n, c in parts])


def title_name_city(title: Column) -> Column:
    """Struct of name and city of a title that says who was killed and where; null parts if it doesn't."""
    part = lambda g: F.nullif(F.trim(F.regexp_extract(title, NAME_AND_CITY, g)), F.lit(""))
    return F.struct(part(1).alias("name"), part(2).alias("city"))


def json_of(raw: Column) -> Column:
    """A model's answer without code fences, if it is JSON; else null."""
    bare = F.regexp_replace(F.regexp_replace(raw, "```(?:json)?\n?", ""), r"^\s+|[`\s]+$", "")
    return F.when(F.try_parse_json(bare).isNotNull(), bare)


def search_queries(name: Column, city: Column, year: Column, terms: list[str], most: int = 8, longest: int = 200) -> Column:
    """Ordered distinct queries from what a case knows, each under the longest length."""
    known = lambda *parts: F.when(sum((F.when(p.isNull(), 1).otherwise(0) for p in parts), F.lit(0)) == 0, F.concat_ws(" ", *[p.cast("string") for p in parts]))
    out = F.array(known(name), known(name, city), known(name, year), *[known(city, F.lit(t), year) for t in terms], *[known(name, F.lit(t)) for t in terms])
    return F.slice(F.array_distinct(F.filter(out, lambda q: q.isNotNull() & (F.length(q) < longest))), 1, most)


def filled_in(template: str, fields: dict[str, Column]) -> Column:
    """A template with its {fields}; {field?} only asks that the field is known. Null if one that it names is blank."""
    known = {k: F.nullif(F.trim(c.cast("string")), F.lit("")) for k, c in fields.items()}
    parts, at = [], 0
    for m in re.finditer(r"\{(\w+)(\??)\}", template):
        parts.append(F.lit(template[at : m.start()]))
        parts.append(F.substring(known[m[1]], 1, 0) if m[2] else known[m[1]])
        at = m.end()
    return F.trim(F.regexp_replace(F.concat(*parts, F.lit(template[at:])), r"\s+", " "))


def tier_queries(fields: dict[str, Column], tier: str, most: int = 6, longest: int = 200) -> Column:
    """The searches of a tier (mainstream, arabic_local, official or arabic) for what a case knows, in order, distinct, the first ones.

    fields: he, ar, city, city_ar, city_en and year.
    """
    out = F.array(*[filled_in(t, fields) for t in SEARCHES[tier]])
    return F.slice(F.array_distinct(F.filter(out, lambda q: q.isNotNull() & (q != "") & (F.length(q) < longest))), 1, most)


def mixed_queries(names: Column, cities: Column, neighborhood: Column, most: int = 8, longest: int = 200) -> Column:
    """Searches of all names with towns of their script, then with words of the crime and of the case, in order, distinct, the first ones."""
    arabic, hebrew = (lambda c: c.rlike("[؀-ۿ]")), (lambda c: c.rlike("[֐-׿]"))
    quoted = lambda n, more: F.concat(F.lit('"'), n, F.lit('" '), more)
    fits = lambda n, c: (arabic(n) & arabic(c)) | (hebrew(n) & hebrew(c)) | ~(arabic(n) | hebrew(n))
    towns = F.flatten(F.transform(names, lambda n: F.transform(F.filter(cities, lambda c: fits(n, c)), lambda c: quoted(n, c))))
    words = lambda ar, he: F.flatten(F.transform(names, lambda n: F.when(arabic(n), F.array(*[quoted(n, F.lit(w)) for w in ar])).when(hebrew(n), F.array(*[quoted(n, F.lit(w)) for w in he])).otherwise(F.array().cast("array<string>"))))
    near = F.when(neighborhood.isNotNull(), F.transform(cities, lambda c: F.concat(neighborhood, F.lit(" "), c))).otherwise(F.array().cast("array<string>"))
    every = F.concat(towns, words(("قتل", "جريمة"), ("רצח", "חשד לרצח")), near, words(("لائحة اتهام",), ("כתב אישום", "משטרה חקירה")))
    return F.slice(F.array_distinct(F.filter(F.transform(every, lambda q: F.trim(F.regexp_replace(q, r"\s+", " "))), lambda q: F.length(q) < longest)), 1, most)
