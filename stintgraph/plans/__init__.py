"""Registered driver queries and their SQL twins."""
