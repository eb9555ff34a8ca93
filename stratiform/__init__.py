"""Layered (bronze, silver, gold) processing of hourly time-series documents on Spark."""
