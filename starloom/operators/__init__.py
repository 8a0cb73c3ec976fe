"""Table operators: pure functions from DataFrames to a DataFrame, plus loads and checks."""
