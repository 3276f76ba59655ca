"""Readers: CSV files, topics, stored tables."""
