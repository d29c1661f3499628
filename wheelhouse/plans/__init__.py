"""Dimensions, facts, graph and analytics built from the operators."""
