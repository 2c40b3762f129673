"""dcflow: ingest, merge and coverage of harvested Dublin Core metadata on Spark.

Layout:
  sources/    landed response pages (read, parse, classify), request plans, the stored table
  functions/  column expressions: whitespace, JSON text, dates
  operators/  record cleaning and validation, filters, coverage (gaps), merge, run ledgers
  plans/      whole jobs (recent, backfill plan, both) and the driver's query catalog
  streaming/  incremental harvest of newly landed pages
"""

__version__ = "0.1.0"
