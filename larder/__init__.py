"""larder: stock reconciliation and data quality on Spark DataFrames."""
