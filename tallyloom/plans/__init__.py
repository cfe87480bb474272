"""Whole jobs: building the warehouse schemas and the named queries."""
