"""DataFrame operators: profiling, conforming, checking, marts and reports.

All take DataFrames and column names, return lazy DataFrames, and know no table by name.
"""
