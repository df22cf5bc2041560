"""Column functions that turn numbers and names into classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vendor sector names to standard names; the order decides which
# partial match wins.
SECTOR_MAPPING = {
    "technology": "Technology",
    "healthcare": "Healthcare",
    "financial services": "Financials",
    "financials": "Financials",
    "finance": "Financials",
    "consumer cyclical": "Consumer Discretionary",
    "consumer discretionary": "Consumer Discretionary",
    "communication services": "Communication Services",
    "industrials": "Industrials",
    "industrial": "Industrials",
    "consumer defensive": "Consumer Staples",
    "consumer staples": "Consumer Staples",
    "energy": "Energy",
    "utilities": "Utilities",
    "real estate": "Real Estate",
    "basic materials": "Materials",
    "materials": "Materials",
    "tech": "Technology",
    "health care": "Healthcare",
    "financial": "Financials",
    "banks": "Financials",
    "insurance": "Financials",
    "retail": "Consumer Discretionary",
    "automotive": "Consumer Discretionary",
    "telecom": "Communication Services",
    "telecommunications": "Communication Services",
    "media": "Communication Services",
    "manufacturing": "Industrials",
    "aerospace": "Industrials",
    "defense": "Industrials",
    "food": "Consumer Staples",
    "beverage": "Consumer Staples",
    "tobacco": "Consumer Staples",
    "oil": "Energy",
    "gas": "Energy",
    "electricity": "Utilities",
    "water": "Utilities",
    "mining": "Materials",
    "chemicals": "Materials",
    "reit": "Real Estate",
}
GICS_SECTORS = (
    "Information Technology", "Health Care", "Financials", "Consumer Discretionary",
    "Communication Services", "Industrials", "Consumer Staples", "Energy", "Utilities",
    "Real Estate", "Materials",
)
# Short names to official names.
SECTOR_ALIASES = {
    "Technology": "Information Technology",
    "Healthcare": "Health Care",
    "Finance": "Financials",
    "Consumer Cyclical": "Consumer Discretionary",
    "Consumer Defensive": "Consumer Staples",
    "Basic Materials": "Materials",
}
# Sectors handed out by hash.
VALID_SECTORS = (
    "Technology", "Financials", "Healthcare", "Consumer Cyclical", "Industrials",
    "Consumer Defensive", "Energy", "Utilities", "Real Estate", "Communication Services",
)
LARGE_CAP = 10_000_000_000
MID_CAP = 2_000_000_000
# Average policy rate by half-open year span.
RISK_FREE_BY_YEAR = {
    (1960, 1970): 0.045,
    (1970, 1980): 0.075,
    (1980, 1990): 0.095,
    (1990, 2000): 0.055,
    (2000, 2008): 0.035,
    (2008, 2015): 0.002,
    (2015, 2020): 0.015,
    (2020, 2022): 0.002,
    (2022, 2030): 0.05,
}
RISK_FREE = 0.05


def _literal_map(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def standardize_sector(col: Column) -> Column:
    """Exact match on the lowered name, else the first key it contains, else the
    name itself if official, else ``Unknown``."""
    name = F.trim(F.lower(col))
    partial = F.coalesce(*[
        F.when(name.contains(key), F.lit(value)) for key, value in SECTOR_MAPPING.items()
    ])
    return F.coalesce(
        F.try_element_at(_literal_map(SECTOR_MAPPING), name),
        partial,
        F.when(col.isin(*GICS_SECTORS), col),
        F.lit("Unknown"),
    )


def alias_sector(col: Column, aliases: Mapping[str, str] = SECTOR_ALIASES) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(aliases), col), col)


def market_cap_category(cap: Column, unknown: bool = True) -> Column:
    out = F.when(cap >= LARGE_CAP, "Large").when(cap >= MID_CAP, "Mid")
    return out.when(cap > 0, "Small").otherwise("Unknown") if unknown else out.otherwise("Small")


def sentiment_category(score: Column) -> Column:
    return F.when(score > 0.1, "positive").when(score < -0.1, "negative").otherwise("neutral")


def buckets(value: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Right-closed buckets between edges; outside or null gives null."""
    return F.coalesce(*[
        F.when((value > lo) & (value <= hi), F.lit(label))
        for lo, hi, label in zip(edges, edges[1:], labels)
    ])


def vix_bucket(vix: Column) -> Column:
    return buckets(vix, (0, 15, 20, 30, 100), ("low_vol", "normal", "elevated", "high_vol"))


def market_regime(vix: Column, unemployment: Column, slope: Column) -> Column:
    vix = F.coalesce(vix, F.lit(20.0))
    unemployment = F.coalesce(unemployment, F.lit(5.0))
    slope = F.coalesce(slope, F.lit(1.0))
    return (
        F.when(vix > 30, "crisis")
        .when(vix > 25, "uncertainty")
        .when(slope < 0, "inversion")
        .when(unemployment > 6, "contraction")
        .when((unemployment < 4) & (vix < 20), "expansion")
        .otherwise("normal")
    )


def risk_free_rate(year: Column, default: float = RISK_FREE) -> Column:
    return F.coalesce(
        *[F.when((year >= a) & (year < b), F.lit(r)) for (a, b), r in RISK_FREE_BY_YEAR.items()],
        F.lit(default),
    )


def hash_sector(ticker: Column) -> Column:
    """A stable sector from md5(ticker) mod 10, taken over four 32-bit parts:
    2^32, 2^64 and 2^96 are all 6 mod 10."""
    digest = F.md5(ticker.cast("binary"))
    part = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") % 10
    rest = ((part(0) + part(1) + part(2)) * 6 + part(3)) % 10
    return F.element_at(F.array(*[F.lit(s) for s in VALID_SECTORS]), (rest + 1).cast("int"))
