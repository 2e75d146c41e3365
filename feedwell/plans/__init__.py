from feedwell.plans.arrivals import ingest_arrivals, load_batch
from feedwell.plans.ingest import Totals, ingest, ingest_file, ingest_loaded
from feedwell.plans.load import feed_counts, rejects, sheet_rows
from feedwell.plans.spec import FeedSpec

__all__ = [
    "FeedSpec", "Totals", "feed_counts", "ingest", "ingest_arrivals", "ingest_file", "ingest_loaded", "load_batch", "rejects",
    "sheet_rows",
]
