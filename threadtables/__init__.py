"""Threaded review notes and author profiles as Spark tables."""
