"""Resumable file streams."""
