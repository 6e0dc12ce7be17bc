"""Sales analytics and weekly demand forecasting on Spark DataFrames."""
