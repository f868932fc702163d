"""Collectibles price analytics and training-data operators on Spark."""
