"""Feeds and stored tables."""
