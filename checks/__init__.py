"""Registered queries, their SQL twins and the harness that compares them."""
