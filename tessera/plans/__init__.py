"""Composite plans (marts) and the registry of named queries."""
