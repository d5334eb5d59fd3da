"""Column functions on URLs of sources: tiers, publishers, sections and gates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casegraph.functions import values as V
from casegraph.functions.text import host, publisher

REGISTRY = {1: V.TIER_1, 2: V.TIER_2, 3: V.TIER_3}


def holds(c: Column, words) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, w))


def official(url: Column, paths=V.OFFICIAL_PATHS, junk=V.OFFICIAL_JUNK) -> Column:
    """The URL looks like a press release or a case document, not like a form or a guide."""
    u = F.lower(F.coalesce(url, F.lit("")))
    return ~holds(u, junk) & holds(u, paths)


def known_domain(url: Column, registry: dict[int, dict[str, str]] = REGISTRY) -> Column:
    """Struct of tier and publisher of the host: of the domain itself, else of the first one, in the registry's order, that it is under; null if unknown."""
    h = host(url)
    flat = [(d, t, n) for t, names in registry.items() for d, n in names.items()]
    make = lambda t, n: F.struct(F.lit(t).alias("tier"), F.lit(n).alias("publisher"))
    out = F.lit(None).cast("struct<tier:int,publisher:string>")
    for d, t, n in reversed(flat):
        out = F.when(F.endswith(h, F.lit(f".{d}")), make(t, n)).otherwise(out)
    for d, t, n in reversed(flat):
        out = F.when(h == d, make(t, n)).otherwise(out)
    return out


def classify(url: Column, registry: dict[int, dict[str, str]] = REGISTRY, paths=V.OFFICIAL_PATHS, junk=V.OFFICIAL_JUNK) -> Column:
    """Struct of tier and publisher: as known_domain(), but an official host has no tier unless the page looks official."""
    found = known_domain(url, registry)
    tier = F.when((found["tier"] == 3) & ~official(url, paths, junk), None).otherwise(found["tier"])
    return F.struct(tier.cast("int").alias("tier"), found["publisher"].alias("publisher"))


def publisher_of(url: Column, registry: dict[int, dict[str, str]] = REGISTRY) -> Column:
    return F.coalesce(known_domain(url, registry)["publisher"], publisher(url))


def tier_score(tier: Column, field: str) -> Column:
    """How much a tier counts for a field: 10 for the most trusted, one less for each after it, 1 for others, 0 without a tier."""
    order = F.array(*[F.lit(t) for t in V.FIELD_TIERS.get(field, (1, 2, 3))])
    at = F.array_position(order, tier)
    return F.when(tier.isNull(), 0).when(at > 0, 11 - at).otherwise(1).cast("int")


def best_tier(field: str) -> int:
    return V.FIELD_TIERS.get(field, (1,))[0]


def allowed_host(url: Column, prefixes: list[str]) -> Column:
    """The URL begins with one of the prefixes."""
    return F.exists(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.startswith(url, p)) if prefixes else F.lit(True)
