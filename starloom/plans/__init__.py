"""The catalogue jobs as functions from tables to tables."""
