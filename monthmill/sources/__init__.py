"""Readers: files to lazy DataFrames."""
