"""All registered queries. Importing a module of queries registers them."""

from rowloom.plans import (  # noqa: F401
    aggregate_queries,
    cleaning_queries,
    encoder_queries,
    ensemble_queries,
    feature_queries,
    metric_queries,
    model_queries,
    neighbour_queries,
    source_queries,
    split_queries,
)
from rowloom.plans.registry import ORACLES, QUERIES  # noqa: F401
