"""Operators: functions from DataFrames or Columns to DataFrames or Columns.

Turns are ARRAY<STRUCT<role, content, tool_calls ARRAY<...>, tool_results ARRAY<...>>>, messages ARRAY<STRUCT<from, value>>.
"""
