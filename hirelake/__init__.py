"""Job-posting collection, normalisation and upkeep as Spark DataFrame jobs."""

__version__ = "0.1.0"
