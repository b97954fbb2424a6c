"""Spark-native wildfire data work: grids, joins, fire life cycles, samples, metrics."""
