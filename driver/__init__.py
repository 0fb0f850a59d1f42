"""Queries of the driver and their SQL oracles over the test tables."""
