"""Names in other scripts: by a dictionary of name parts where it knows them, else by letters."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from casegraph.functions import values as V
from casegraph.functions.text import SCRIPTS, romanize

#: Dictionary parts by Arabic form: {"ar": {"he": ..., "en": ...}}.
Dictionary = dict[str, dict[str, str]]


def _letters(c: Column, table: dict[str, str]) -> Column:
    """Each letter by the table; others stay."""
    for k, v in table.items():
        if len(v) != 1:
            c = F.replace(c, F.lit(k), F.lit(v))
    single = {k: v for k, v in table.items() if len(v) == 1}
    return F.translate(c, "".join(single), "".join(single.values()))


def arabic_to_hebrew(c: Column) -> Column:
    return _letters(c, V.ARABIC_TO_HEBREW)


def hebrew_to_arabic(c: Column) -> Column:
    for k, v in V.HEBREW_DIGRAPHS.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return _letters(c, V.HEBREW_TO_ARABIC)


def readable_latin(c: Column) -> Column:
    """Romanised, with an a between neighbouring consonants and a capital at the front."""
    return F.initcap(F.regexp_replace(romanize(c), "(?<=[^aeiou ])(?=[^aeiou ])", "a"))


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*table.items())]), key) if table else F.lit(None).cast("string")


def reverse(dictionary: Dictionary, script: str) -> dict[str, str]:
    """Arabic forms by those of another script; the last of several wins."""
    return {v[script]: k for k, v in dictionary.items() if v.get(script)}


def transliterate(text: Column, source: str, target: str, dictionary: Dictionary | None = None) -> Column:
    """Struct of value and method (dictionary or rule_based); null for blank text or a pair of scripts that has no rule."""
    none = F.lit(None).cast("struct<value:string,method:string>")
    if source == target or source not in ("ar", "he") or target not in ("ar", "he", "en"):
        return none
    known = dictionary or {}
    if source == "ar":
        table = {k: v[target] for k, v in known.items() if v.get(target)}
    else:
        table = {h: a if target == "ar" else known[a].get(target, "") for h, a in reverse(known, "he").items()}
        table = {k: v for k, v in table.items() if v}
    rule = readable_latin if target == "en" else arabic_to_hebrew if source == "ar" else hebrew_to_arabic
    words = F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")
    out = F.array_join(F.filter(F.transform(words, lambda t: F.coalesce(_lookup(table, t), rule(t))), lambda t: t != ""), " ")
    method = F.when(F.exists(words, lambda t: _lookup(table, t).isNotNull()), "dictionary").otherwise("rule_based")
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", none).when(out == "", none).otherwise(F.struct(out.alias("value"), method.alias("method")))


KIND = "array<struct<value:string,target_script:string,source_script:string,method:string,source_value:string>>"


def missing_scripts(names: dict[str, Column], existing: Column, dictionary: Dictionary | None = None) -> Column:
    """existing with a form for each script without a name of its own, from the first of ar, he and en that has one; nothing is added twice."""
    has = {s: F.coalesce(F.trim(c), F.lit("")) != "" for s, c in names.items()}
    made = []
    for target in ("ar", "he", "en"):
        best = F.lit(None).cast("struct<value:string,target_script:string,source_script:string,method:string,source_value:string>")
        for source in reversed([s for s in ("ar", "he", "en") if s != target]):
            value = F.trim(names[source])
            got = transliterate(value, source, target, dictionary)
            full = F.struct(got["value"].alias("value"), F.lit(target).alias("target_script"), F.lit(source).alias("source_script"), got["method"].alias("method"), value.alias("source_value"))
            best = F.when(has[source], F.when(got.isNotNull(), full)).otherwise(best)
        made.append(F.when(~has[target], best))
    start = F.coalesce(existing, F.array().cast(KIND))
    new = F.filter(F.array(*made).cast(KIND), lambda t: t.isNotNull() & ~F.exists(start, lambda x: (x["target_script"] == t["target_script"]) & (x["source_script"] == t["source_script"]) & (x["value"] == t["value"])))
    return F.concat(start, new)


def roman_name(c: Column) -> Column:
    """Capital Latin letters for an identifier: known Arabic name parts by the fixed table, others letter by letter, joined by hyphens."""
    words = F.transform(F.split(F.trim(c), r"\s+"), lambda t: F.regexp_replace(t, "^[،,.;:!?]+|[،,.;:!?]+$", ""))
    parts = F.transform(words, lambda t: F.coalesce(_lookup(V.ARABIC_ROMAN_NAMES, t), F.regexp_replace(F.upper(romanize(t)), "[^A-Z]", "")))
    return F.array_join(F.filter(parts, lambda t: t != ""), "-")


def case_id(incident: Column, death: Column, city: Column, name_en: Column, name_ar: Column, name_he: Column, otherwise: Column) -> Column:
    """IL-HOMICIDE-year-CITY-NAME from what is known; kept as it was if year, city and name leave but one part."""
    year = F.substring(F.coalesce(incident, death).cast("string"), 1, 4)
    town = F.when(F.coalesce(city, F.lit("")) != "", F.regexp_replace(F.upper(city), "[^A-Z]", ""))
    blank = lambda c: F.nullif(c, F.lit(""))
    name = F.coalesce(blank(name_en), blank(roman_name(F.coalesce(name_ar, F.lit("")))), blank(roman_name(F.coalesce(name_he, F.lit("")))))
    clean = blank(F.regexp_replace(F.replace(F.upper(name), F.lit(" "), F.lit("-")), "[^A-Z-]", ""))
    known = F.filter(F.array(F.lit("IL"), F.lit("HOMICIDE"), year, town, clean), lambda p: p.isNotNull())
    return F.when(F.size(known) >= 4, F.array_join(known, "-")).otherwise(otherwise)


def pure(c: Column, script: str) -> Column:
    """The text has letters of this script and of no other."""
    of = {"ar": "arabic", "he": "hebrew", "en": "latin"}
    others = "".join(V_SCRIPTS[s] for k, s in of.items() if k != script)
    return F.coalesce(c.rlike(f"[{V_SCRIPTS[of[script]]}]") & ~c.rlike(f"[{others}]"), F.lit(False))


#: Letters of the scripts of names, presentation forms included.
V_SCRIPTS = {"arabic": r"؀-ۿݐ-ݿﭐ-﷿ﹰ-﻿", "hebrew": r"֐-׿יִ-ﭏ", "latin": SCRIPTS["latin"]}
