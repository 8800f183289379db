"""Subpackage of the engine."""
