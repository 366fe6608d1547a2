"""Runs that build and refresh the tables."""
