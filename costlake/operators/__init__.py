"""Operators on DataFrames: contract, writes, joins, controls, scoping."""
