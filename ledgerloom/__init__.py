"""Ledger and weather data jobs written with the PySpark DataFrame API."""
