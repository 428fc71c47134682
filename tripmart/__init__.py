"""tripmart: quality-gated analytics marts over large trip-fact data, on Spark.

Every public operator takes and returns a DataFrame; nothing is collected to
the driver except one-row reports and pivot column labels.
"""

__version__ = "0.1.0"
