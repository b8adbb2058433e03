"""Strata: a layered (Bronze / Silver / Gold) market-data engine on Spark DataFrames."""
