"""Relational building blocks that hold under skew."""
