"""Column functions: times, paths, text parsing and station ids."""
