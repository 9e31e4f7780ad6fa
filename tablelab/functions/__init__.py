"""Column expressions: plain functions from Columns to a Column."""
