"""Contracts as data: types, resolution, row rules, versions."""
