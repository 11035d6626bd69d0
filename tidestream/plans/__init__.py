"""Whole jobs made of the operators, and the registry of queries."""
