from feedwell.sources.files import (
    count_files, latest_files, list_files, listing, match_names, newest_first, open_directory, read_file, read_files,
)
from feedwell.sources.workbook import read_parts

__all__ = [
    "count_files", "latest_files", "list_files", "listing", "match_names", "newest_first", "open_directory", "read_file",
    "read_files", "read_parts",
]
