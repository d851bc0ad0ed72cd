"""Complaint analytics on PySpark: land, load, model, test and query multi-channel complaint data."""
