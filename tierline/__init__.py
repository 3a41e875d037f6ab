"""tierline — medallion-style analytics on Spark.

Raw captures land as column-store JSON envelopes; bronze decodes them by
header name and keeps the latest capture per natural key; silver builds
dimensions, facts and season-bounded SCD2 intervals; quality checks return
only violating rows and carry anti-vacuity floors.  Every operator takes
column names as arguments, so the same code runs on box scores and on any
relational or event table.
"""

__version__ = "0.1.0"
