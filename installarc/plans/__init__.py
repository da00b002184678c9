"""User-level pipelines: one function per mart, DataFrames in, DataFrame out."""
