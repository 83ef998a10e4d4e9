"""Registered queries, products and runs."""
