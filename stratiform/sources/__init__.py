"""Landed documents, hourly series, locations, tables."""
