"""Ledgerlark: disclosure, discussion-board and statement analytics on PySpark.

The package works on tables of material that has already landed (pages, feed
JSON, statements, logs, documents, embeddings, conversations).  Every public
function takes and returns Spark columns or DataFrames; nothing is collected
to the driver except single header rows and query vectors.
"""

__version__ = "0.1.0"
