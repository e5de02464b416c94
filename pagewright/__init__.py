"""Web-document structuring and incremental sync on Spark DataFrames."""
