"""Fixed orderings of categorical text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank of each value within its ordered category.
ORDINAL_MAPS: dict[str, dict[str, int]] = {
    "level": {"Entry": 1, "Junior": 2, "Mid": 3, "Senior": 4, "Executive": 5},
    "education": {"High School": 1, "Associates": 2, "Bachelors": 3, "Masters": 4, "PhD": 5, "Professional": 5},
    "age_bucket": {"20-29": 1, "30-39": 2, "40-49": 3, "50-59": 4, "60+": 5},
    "years_experience_bucket": {"0-2": 1, "3-5": 2, "6-10": 3, "11-15": 4, "16-20": 5, "21+": 6},
    "salary_category": {"Low": 0, "Medium": 1, "High": 2},
}


def ordinal_map(col: Column, ranks: dict[str, int]) -> Column:
    """Rank of a value; values outside the map become null."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(ranks.items())])
    return F.try_element_at(table, col)
