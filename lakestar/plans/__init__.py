"""Composite tables and reports built from the operators."""
