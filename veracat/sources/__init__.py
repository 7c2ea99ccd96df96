"""Readers. Each returns a DataFrame and leaves splitting and scheduling to Spark."""
