"""Writing the lake, publishing slices of it, reports."""
