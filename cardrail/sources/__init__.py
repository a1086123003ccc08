"""Topics, CSV files and change events as DataFrames."""
