"""Spark-native engine for sky-raster templates: mapping, band combination, stitching, re-binning, inventory."""
