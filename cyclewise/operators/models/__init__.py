"""Anomaly scorers: isolation forest, reconstruction error, forecast error."""
