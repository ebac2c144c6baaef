"""Operators for preparing training text: one module for each, and the queries that apply them."""
