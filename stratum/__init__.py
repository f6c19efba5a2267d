"""stratum: medallion lakehouse analytics (bronze -> silver -> gold star -> measures) on Spark DataFrames."""

__version__ = "0.1.0"
