"""Chains of operators that make up the batch jobs."""
