"""Basket analytics and reorder prediction as plain Spark DataFrame functions."""
