"""Ledgerloom: versioned document-catalog analytics on Spark DataFrames."""
