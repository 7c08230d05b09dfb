"""Readers of the raw landing area."""
