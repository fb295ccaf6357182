from adfeat.streaming.counts import (
    compact_changelog,
    impression_stream,
    latest_cells,
    latest_counts,
    remove_folded,
    streaming_cells,
    streaming_key_counts,
    write_changelog,
)

__all__ = [
    "compact_changelog",
    "impression_stream",
    "latest_cells",
    "latest_counts",
    "remove_folded",
    "streaming_cells",
    "streaming_key_counts",
    "write_changelog",
]
