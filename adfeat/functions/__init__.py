from adfeat.functions.derive import (
    category_key,
    hour_of,
    index_or_minus1,
    indicator,
    list_length,
    min_max_scaled,
    parse_time,
    predicted_categories,
    property_at,
    split_list,
)
from adfeat.functions.digamma import digamma, digamma_diff

__all__ = [
    "category_key",
    "digamma",
    "digamma_diff",
    "hour_of",
    "index_or_minus1",
    "indicator",
    "list_length",
    "min_max_scaled",
    "parse_time",
    "predicted_categories",
    "property_at",
    "split_list",
]
