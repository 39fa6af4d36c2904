"""Whole jobs: chains of operators, and the documented analyses over the lake tables."""
