"""Spark-native analytics for image-based spatial transcriptomics tables."""
