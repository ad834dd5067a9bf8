"""Operators, one module per stage."""
