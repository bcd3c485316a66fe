"""Composite chains and the query catalog."""
