"""Queries and datasets composed from the operators."""
