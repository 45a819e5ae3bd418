"""Analytical results built from the operators."""
