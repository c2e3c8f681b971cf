"""Operators on DataFrames: batching, ledgers, joins, assembly and engine stages."""
