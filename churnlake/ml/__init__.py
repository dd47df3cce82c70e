"""Spark ML: splits, weights, model fits, tuning, calibration."""
