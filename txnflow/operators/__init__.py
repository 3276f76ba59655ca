"""Set-based operators on DataFrames."""
