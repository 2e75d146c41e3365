"""What to look for in the files of one run."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedwell.functions.cells import NA_WORDS
from feedwell.functions.names import marker_key, prefix_key
from feedwell.functions.paths import basename


@dataclass(frozen=True)
class FeedSpec:
    """Parameters of a load.

    ``columns`` maps canonical names to header prefixes, all required; ``key``
    is the one whose blank rows are dropped. A flag header starts with
    ``flag_prefix`` and contains one of ``flag_markers``; it may be absent.
    ``feed`` maps a file name to its feed, the empty text standing for NULL; without it all files are one feed.
    """

    name_regex: str
    sheet_prefix: str
    columns: Mapping[str, str]
    key: str
    flag_prefix: str
    flag_markers: tuple[str, ...]
    feed: Callable[[Column], Column] | None = None
    na_words: tuple[str, ...] = NA_WORDS

    def __post_init__(self):
        if self.key not in self.columns:
            raise ValueError(f"key {self.key!r} is not one of the columns {list(self.columns)}")
        for prefix in (self.sheet_prefix, self.flag_prefix, *self.columns.values()):
            prefix_key(prefix)
        if not self.flag_markers:
            raise ValueError("at least one flag marker is needed")
        for marker in self.flag_markers:
            marker_key(marker)

    def feed_of(self, path: str = "path") -> Column:
        return F.lit("") if self.feed is None else F.nullif(self.feed(basename(path)).cast("string"), F.lit(""))
