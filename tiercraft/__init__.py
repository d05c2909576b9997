"""Layered (bronze -> silver -> gold) usage analytics expressed with Spark DataFrames."""
