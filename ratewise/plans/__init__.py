"""Workflows assembled from operators: exploration, features, models, tuning."""
