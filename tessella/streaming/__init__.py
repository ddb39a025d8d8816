"""Stateful operators."""
