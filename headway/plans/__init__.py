"""Whole jobs and analytical queries."""
