"""Inputs: the given tables, the order feed, metric samples and landing files."""
