"""screenroi: content return-on-investment analytics written as Spark DataFrame jobs.

Layout
------
functions/  Column -> Column helpers (names, lenient casts, domain mappings)
operators/  DataFrame -> DataFrame steps (cleaners, usage, licence pick, warehouse, models, quality)
sources/    readers and writers (raw CSV zone, curated Parquet, play-event JSON, driver bindings)
plans/      whole jobs and the registered query catalogue
streaming/  Structured Streaming usage jobs
"""

__version__ = "0.1.0"
