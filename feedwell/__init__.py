"""Loads spreadsheet workbooks whose names and headers drift into managed tables, on Spark."""

from feedwell.plans import FeedSpec, Totals, ingest, ingest_arrivals, ingest_file, ingest_loaded

__all__ = ["FeedSpec", "Totals", "ingest", "ingest_arrivals", "ingest_file", "ingest_loaded"]
