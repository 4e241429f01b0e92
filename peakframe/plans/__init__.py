"""Queries of the library. Importing this package registers them all."""

from peakframe.plans import catalog_queries, event_queries, histogram_queries, layout_queries, report_queries  # noqa: F401
