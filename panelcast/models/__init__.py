"""Forecasting model jobs on Spark ML (pooled panel fits per grid cell)."""
