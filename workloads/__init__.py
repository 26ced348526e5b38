"""Inputs and queries that run the package over the driver's tables."""
