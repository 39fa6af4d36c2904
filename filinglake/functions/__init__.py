"""Column expressions shared by the jobs. All native, no Python workers."""
