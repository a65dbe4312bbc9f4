"""Capture-dataset and training-data operators on Spark."""
