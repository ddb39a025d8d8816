"""Scalar, pixel and schedule functions."""
