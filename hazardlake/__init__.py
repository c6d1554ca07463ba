"""hazardlake: hazard-event analytics as PySpark DataFrame jobs.

functions/  Column expressions (JVM-side)
sources/    readers for landed feeds, logs, posts, articles
operators/  DataFrame -> DataFrame building blocks
streaming/  Structured Streaming ingest and windows
plans/      the registered queries over the shared test tables and their SQL oracle
"""
