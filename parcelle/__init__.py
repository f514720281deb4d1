"""Property-sale analytics on Spark: typed cleaning of raw sale lines,
per-sale aggregation, landing-file bookkeeping, paged JSON records and
area polygons, all as DataFrame plans."""

__version__ = "0.1.0"
