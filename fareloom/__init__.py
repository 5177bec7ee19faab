"""Batch, streaming and regression analytics on trips and events, on plain Spark."""
