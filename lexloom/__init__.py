"""Structured numeric rules from legal text, and training-data operators, on Spark."""
