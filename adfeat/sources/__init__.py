from adfeat.sources.schema import (
    ATTRIBUTE_FIELDS,
    IMPRESSION_FIELDS,
    IMPRESSION_SCHEMA,
    read_impressions,
)
from adfeat.sources.views import imp_events, imp_lineitem, split_by_time

__all__ = [
    "ATTRIBUTE_FIELDS",
    "IMPRESSION_FIELDS",
    "IMPRESSION_SCHEMA",
    "imp_events",
    "imp_lineitem",
    "read_impressions",
    "split_by_time",
]
