"""Operators of the job, each a function from DataFrame to DataFrame."""
