"""Spark-native analytics over aviation geography: map extracts, airports, obstacles, airspace, rasters and feeds."""
