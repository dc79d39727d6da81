"""Scalar functions, Column in and Column out; built-in expressions only."""
