"""Customer-terminal graph analytics on plain DataFrames (no graph library)."""
