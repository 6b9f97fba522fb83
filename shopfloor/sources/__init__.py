"""Readers for the five tables."""
