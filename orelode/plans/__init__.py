"""Whole jobs: the layered build, the business questions and the report."""
