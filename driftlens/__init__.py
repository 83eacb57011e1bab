"""Spark-native analytics for schedule slips and taxonomy-scored text."""
