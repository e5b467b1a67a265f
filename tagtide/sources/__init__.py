"""Feeds and tables to read from."""
