"""Readers that turn files and raw texts into tables."""
