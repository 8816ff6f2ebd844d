"""Readers that turn feeds, pages, event streams and tables into DataFrames."""
