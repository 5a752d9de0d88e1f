"""Landed feeds, catalog tables and constant relations."""
