"""Sheafline: a PySpark engine for building and checking collections of structured texts."""

__version__ = "0.1.0"
