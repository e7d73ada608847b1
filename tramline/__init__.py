"""Public-transport accessibility analytics as lazy Spark DataFrames."""
