"""Readers: message broker, envelopes, lake folders, and the test tables."""
