"""millrace: warehouse pipeline operators and jobs written for Spark.

Sub-packages
    functions   column expressions (text, nested documents, measures)
    operators   DataFrame -> DataFrame building blocks
    sources     reading and writing files and tables
    streaming   file-at-most-once ingestion, incremental upserts, mart refresh
    plans       complete jobs composed from the blocks above
"""
