"""Operators over DataFrames: spatial joins, tags, ways, change feeds, regions, rasters, quality checks."""
