"""Readers for stored tables, landed feeds and the driver's test tables."""
