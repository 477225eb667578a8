"""Data quality, profiling and layered loading of dirty banking tables on Spark DataFrames."""
