"""Composite queries: what a user of the engine calls."""
