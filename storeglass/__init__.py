"""Retail analytics as Spark jobs: every job is a function from tables to a DataFrame."""
