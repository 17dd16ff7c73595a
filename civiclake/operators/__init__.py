"""DataFrame operators: each takes DataFrames, column names and rule tables, and returns a DataFrame."""
