"""martlet: a retail medallion data mart (bronze -> silver -> gold) and its
analytical query library, written with Spark DataFrame, SQL and Structured
Streaming operators."""

__version__ = "0.1.0"
