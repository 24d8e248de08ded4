"""rowloom: tabular feature engineering and classification on Spark DataFrames."""
