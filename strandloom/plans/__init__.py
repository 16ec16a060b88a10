"""Registered queries, their SQL oracles and the projections of the driver's tables."""
