"""Runs over catalog tables, composed of operators."""
