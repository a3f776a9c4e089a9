"""Composite plans (PIPE-*) and the registry of checked queries."""
