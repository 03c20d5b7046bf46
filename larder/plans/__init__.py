"""Composed grocery jobs. Inputs are DataFrames; every "now" is an argument."""
