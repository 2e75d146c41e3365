from feedwell.sinks.commits import append_decided
from feedwell.sinks.folder import shared_folder, staging
from feedwell.sinks.tables import (
    append_changes, append_history, read_history, replace_feeds, with_feed_and_time, write_current,
)

__all__ = [
    "append_changes", "append_decided", "append_history", "read_history", "replace_feeds", "shared_folder", "staging",
    "with_feed_and_time", "write_current",
]
