"""DataFrame operators for single-cell variant, copy-number and QC tables.

Every operator takes and returns DataFrames (or Columns) and stays lazy: one
cohort is one Catalyst plan from source to sink.
"""
