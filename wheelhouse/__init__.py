"""Wheelhouse: shared-mobility and sales analytics as composable PySpark DataFrame operators."""
