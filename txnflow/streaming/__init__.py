"""Micro-batch loading and the starting of streams."""
