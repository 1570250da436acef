"""Labelled-flow analytics over Spark DataFrames."""
