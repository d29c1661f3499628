"""Parametric DataFrame operators."""
