"""flowtable: dataflow operators for tables and streams on Spark DataFrames."""

__version__ = "0.1.0"
