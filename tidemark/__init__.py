"""Catalogue resolution, price analytics and corpus preparation on Spark."""
