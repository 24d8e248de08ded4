"""Keyword flags of a title, and region flags of a state code."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Three keyword tables. Patterns match anywhere in the lower-cased title.
TITLE_KEYWORDS: dict[str, dict[str, str]] = {
    "package": {
        "is_senior": "senior|sr|lead|principal|mgr|manager",
        "is_junior": "junior|jr|intern|associate|entry|grad",
        "is_engineer": "engineer|developer|programmer|software|swe",
        "is_analyst": "analyst|analysis",
        "is_data_scientist": "data scientist|scientist",
        "is_manager": "manager|mgr|director|vp|head",
    },
    "advanced": {
        "is_senior": "senior|sr|lead|principal",
        "is_junior": "junior|jr|associate|entry",
        "is_developer": "develop|programmer|coder|engineer",
        "is_specialist": "special|expert|consult",
    },
    "intermediate": {
        "is_senior": "senior|sr|lead|principal|staff|architect|head",
        "is_junior": "junior|jr|associate|entry|intern",
        "is_manager": "manager|director|lead|head",
        "is_developer": "developer|engineer|programmer|coder",
        "is_data": "data|scientist|analyst|analytics",
    },
}

# US state codes by region.
US_REGIONS: dict[str, list[str]] = {
    "Northeast": "ME NH VT MA RI CT NY NJ PA".split(),
    "Midwest": "OH MI IN IL WI MN IA MO ND SD NE KS".split(),
    "South": "DE MD DC VA WV NC SC GA FL KY TN AL MS AR LA OK TX".split(),
    "West": "MT ID WY CO NM AZ UT NV CA OR WA AK HI".split(),
}


def has_any(text: Column, pattern: str) -> Column:
    """Whether a pattern matches anywhere; alternatives of plain words are searched as bytes."""
    words = pattern.split("|")
    if all(re.fullmatch(r"[\w ]+", w) for w in words):
        return reduce(lambda a, b: a | b, [text.contains(w) for w in words])
    return text.rlike(pattern)


def keyword_flags(col: Column, table: dict[str, str]) -> list[Column]:
    title = F.lower(F.coalesce(col, F.lit("unknown")))
    return [has_any(title, pattern).cast("int").alias(name) for name, pattern in table.items()]


def region_flags(col: Column, regions: dict[str, list[str]] = US_REGIONS) -> list[Column]:
    return [
        F.when(col.isin(codes), 1).otherwise(0).alias(f"region_{name}")
        for name, codes in regions.items()
    ]
