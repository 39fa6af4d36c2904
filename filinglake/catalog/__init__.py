"""The registered queries: disclosure-shaped views of the given tables, jobs on them, their SQL."""
