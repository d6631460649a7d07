"""airlens: daily air quality and weather analytics, written as Spark DataFrame plans.

Layout
------
functions/  column expressions (rounding, percentages, arg-max names, bands, statuses)
sources/    schemas, raw file ingest, payload flattening, adapters from the test tables
operators/  staging, marts, monitoring, quality rules, analyses (DataFrame -> DataFrame)
plans/      the full rebuild, published views, read-only SQL, query registry, oracle SQL
streaming/  exactly-once file ingest with Structured Streaming (availableNow)
"""

__version__ = "0.1.0"
