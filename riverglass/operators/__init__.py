"""The analyses. Each function takes and returns DataFrames and runs no action of its own,
except where its docstring says so."""
