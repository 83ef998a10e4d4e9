"""Operators over DataFrames, each with its method and defined results in its docstring."""
