"""Indexloom: document-intelligence, scoring and ranking operators on Spark DataFrames."""
