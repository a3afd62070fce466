"""Analytical queries and the batch load, composed from the operators."""
