"""ledgerline: order, retail and record analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames or Columns; nothing is
collected to the driver. Sub-packages:

* ``sources``   – scans and sinks (Parquet, CSV, folder scans, overwrite sinks)
* ``functions`` – column expressions (safe casts, scalars, rule predicates)
* ``operators`` – relational building blocks (first-wins, top-k, histograms, ...)
* ``plans``     – the reference's pipelines and queries, composed from the above
* ``streaming`` – Structured Streaming intake jobs
"""

__version__ = "0.1.0"
