"""pricetide: price-monitoring analytics expressed as Spark DataFrame / SQL jobs.

Layout
------
functions/   Column -> Column helpers (rounding, price text, names, urls)
sources/     readers for the driver tables, star-schema adapters, raw listings, sinks
operators/   cleaning, change detection, load/merge, analytics, derived metrics, extraction
plans/       SQL variants and the query registry used by ``__spark_entry__``
streaming/   Structured Streaming versions of the incremental load
"""

__version__ = "0.1.0"
