"""Scalar functions over text, markup, numbers and geometry."""
