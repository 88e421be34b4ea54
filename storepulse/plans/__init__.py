"""Questions the dashboard asks, as DataFrames."""
