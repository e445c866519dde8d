"""Registered queries: each operator on tables derived from the driver's, next to equivalent SQL."""
