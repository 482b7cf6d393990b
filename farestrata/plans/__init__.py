"""Whole jobs: the layered pipeline, the declared checks and the registered queries."""
