"""The engine's operators: DataFrames and parameters in, one DataFrame out."""
