"""Sources: the CSV landing folder, stored tables, and feeds derived from the test tables."""

from shedlake.sources.landing import header_groups, infer_feed_schema, new_files_stream, read_files
from shedlake.sources.tables import batch_table, bronze_change_feed, register_table, stream_table

__all__ = [
    "batch_table",
    "bronze_change_feed",
    "header_groups",
    "infer_feed_schema",
    "new_files_stream",
    "read_files",
    "register_table",
    "stream_table",
]
